"""Cleaning of keys, dates and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from lendmart import fixed_values as fv
from lendmart.functions import dates, text
from lendmart.operators import rows
from lendmart.plans.lead_details import eav_values


def title_sql(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END || w[2:]), ' ')"


def tokens_sql(tokens) -> str:
    return text.alternation([t.replace("{brand}", "platform") for t in tokens]).replace("'", "''")


@query("active_only", uses="state_log raw_users", sql="""
SELECT 'log' AS part, id FROM state_log WHERE deleted = 'N'
UNION ALL SELECT 'users', uid FROM (SELECT uid, CASE WHEN uid % 2 = 0 THEN deleted END AS d FROM raw_users) u WHERE d = 'N' OR d IS NULL""")
def _(i):
    log = rows.active_only(i.state_log).select(F.lit("log").alias("part"), "id")
    some = i.raw_users.select("uid", F.when(F.col("uid") % 2 == 0, F.col("deleted")).alias("deleted"))
    users = rows.active_only(some, tolerate_null=True)
    return log.unionByName(users.select(F.lit("users").alias("part"), F.col("uid").alias("id")))


@query("drop_exact_duplicates", uses="inst", sql="""
SELECT DISTINCT loan_id, lender, state, CAST(date_trunc('month', due) AS DATE) AS month FROM inst""")
def _(i):
    return rows.drop_exact_duplicates(i.inst.select("loan_id", "lender", "state", F.trunc("due", "month").alias("month")))


@query("epoch_to_local_date", uses="raw_installments inst", sql="""
SELECT uid_l, due_date, CAST(DATE '1970-01-01' + CAST((due_date + 19800) // 86400 AS INT) AS DATE) AS due,
       CAST(DATE '1970-01-01' + CAST(udated // 86400 AS INT) AS DATE) AS updated_utc FROM raw_installments""")
def _(i):
    return i.raw_installments.select("uid_l", "due_date", dates.epoch_to_local_date("due_date").alias("due"),
                                     dates.epoch_to_local_date("udated", 0).alias("updated_utc"))


@query("safe_epoch_date", uses="raw_users", sql="""
SELECT uid, dob * 3 AS dob, CASE WHEN dob * 3 <= 2147463847 THEN CAST(DATE '1970-01-01' + CAST(floor((dob * 3 + 19800) / 86400) AS INT) AS DATE)
       WHEN dob * 3 <= 2147483647 THEN DATE '2038-01-19' END AS born FROM raw_users""")
def _(i):
    return i.raw_users.select("uid", (F.col("dob") * 3).alias("dob")).withColumn("born", dates.safe_epoch_date("dob"))


@query("clean_entity_id", uses="state_log", sql="""
SELECT id, logged_entity_id, CASE WHEN length(s) <= 10 THEN TRY_CAST(s AS BIGINT) END AS entity
FROM (SELECT *, regexp_replace(logged_entity_id, '[.'' ]', '', 'g') AS s FROM state_log)""")
def _(i):
    return i.state_log.select("id", "logged_entity_id", text.clean_entity_id("logged_entity_id").alias("entity"))


_DATE8 = "CASE WHEN regexp_matches({p}, '^[0-9]{{8}}$') THEN CAST(try_strptime({p}, '%d%m%Y') AS DATE) END"


@query("parse_messy_date", uses="messy_dates", sql=f"""
SELECT id, line, part, raw, CASE WHEN length(s) = 10 THEN CAST(DATE '1970-01-01' + CAST((TRY_CAST(s AS BIGINT) + 19800) // 86400 AS INT) AS DATE)
       WHEN length(s) = 7 THEN {_DATE8.format(p="('0' || s)")} WHEN length(s) = 8 THEN {_DATE8.format(p='s')} END AS day
FROM (SELECT *, regexp_replace(CASE WHEN raw = '050102017' THEN '05102017' ELSE raw END, '[^0-9]', '', 'g') AS s FROM messy_dates)""")
def _(i):
    return i.messy_dates.withColumn("day", dates.parse_messy_date("raw", "[^0-9]", fv.START_DATE_REPAIRS))


_PHONE = "regexp_replace(regexp_replace(regexp_replace({c}, '\\+91', '', 'g'), '[^0-9]', '', 'g'), '^0+', '')"


def phone_sql(c):
    s = f"right({_PHONE.format(c=c)}, 10)"
    return f"CASE WHEN regexp_matches({s}, '^[6-9][0-9]{{9}}$') THEN {s} END"


@query("normalize_phone", uses="messy_text raw_users", sql=f"""
SELECT id, {phone_sql('text')} AS phone FROM messy_text
UNION ALL SELECT -uid, {phone_sql('mobile')} FROM raw_users
UNION ALL SELECT -uid, {phone_sql('landline')} FROM raw_users""")
def _(i):
    t = i.messy_text.select("id", text.normalize_phone("text").alias("phone"))
    u = i.raw_users
    return (t.unionByName(u.select((-F.col("uid")).alias("id"), text.normalize_phone("mobile").alias("phone")))
             .unionByName(u.select((-F.col("uid")).alias("id"), text.normalize_phone("landline").alias("phone"))))


@query("extract_national_id", uses="raw_users", sql=f"""
SELECT uid, pan, nullif(regexp_extract(upper(trim(right(trim(regexp_replace(lower(pan), '{tokens_sql(fv.ID_STATUS_TOKENS)}', '', 'g')), 10))),
       '[A-Z]{{{{5}}}}[0-9]{{{{4}}}}[A-Z]'), '') AS user_pan FROM raw_users""".replace("{{", "{").replace("}}", "}"))
def _(i):
    t = [x.replace("{brand}", "platform") for x in fv.ID_STATUS_TOKENS]
    return i.raw_users.select("uid", "pan", text.extract_national_id("pan", t).alias("user_pan"))


@query("scrub_status_prefix", uses="logins", sql=f"""
SELECT uid, trim(regexp_replace(regexp_replace(lower(name), '{tokens_sql(fv.NAME_STATUS_TOKENS)}', '', 'g'), '\\.', ' ', 'g')) AS clean_name,
       trim(regexp_replace(lower(mail), '{tokens_sql(fv.NAME_STATUS_TOKENS)}', '', 'g')) AS clean_mail FROM logins""")
def _(i):
    t = [x.replace("{brand}", "platform") for x in fv.NAME_STATUS_TOKENS]
    return i.logins.select("uid", text.scrub_status_prefix("name", t, dots_to_space=True).alias("clean_name"),
                           text.scrub_status_prefix("mail", t).alias("clean_mail"))


@query("title_clean", uses="identity_addresses", sql=f"""
SELECT id, coalesce({title_sql("trim(regexp_replace(name, 'null', '', 'g'))")}, '') AS name,
       coalesce({title_sql("trim(regexp_replace(street, 'null', '', 'g'))")}, '') AS street,
       coalesce({title_sql("""trim(regexp_replace("House_number", 'null', '', 'g'))""")}, '') AS house FROM identity_addresses""")
def _(i):
    return i.identity_addresses.select("id", text.title_clean("name").alias("name"), text.title_clean("street").alias("street"),
                                       text.title_clean("House_number").alias("house"))


@query("compose_address", uses="raw_users", sql=f"""
SELECT uid, regexp_replace(regexp_replace({title_sql('''trim(coalesce(address, '') || ' ' || coalesce("add", '') || ' ' || coalesce(add2, '') || ' ' || coalesce(landmark, ''))''')},
       '[\\n|\\r]+', ',', 'g'), '  +', ' ', 'g') AS full_address FROM raw_users""")
def _(i):
    return i.raw_users.select("uid", text.compose_address(["address", "add", "add2", "landmark"]).alias("full_address"))


@query("decode", uses="raw_loans dictionary", sql="""
SELECT l.id, l.loan_type_cnd, coalesce(d.cnd_name, CAST(l.loan_type_cnd AS VARCHAR)) AS loan_type, s.cnd_name AS state_name
FROM raw_loans l LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group IN ('INDIA_LOAN', 'LOAN_CITY')) d ON d.id = l.loan_type_cnd
LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group = 'LOAN_STATE') s ON s.cnd_code = l.loan_state""")
def _(i):
    d = rows.active_only(i.dictionary)
    out = rows.decode(i.raw_loans.select("id", "loan_type_cnd", "loan_state"), "loan_type_cnd", d, ["INDIA_LOAN", "LOAN_CITY"],
                      "loan_type", default=F.col("loan_type_cnd").cast("string"))
    return rows.decode(out, "loan_state", d, fv.LOAN_STATE_GROUP, "state_name", key="cnd_code", fold_case=True, unique=False).drop("loan_state")


@query("decode_embedded_code", uses="raw_loans dictionary", sql="""
SELECT l.id, coalesce(d.cnd_name, l.loan_city) AS loan_city FROM raw_loans l
LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group IN ('LOAN_CITY', 'STATE_PIN', 'STATE_INDIA', 'CORONA_CITY')) d
  ON CAST(d.id AS VARCHAR) = regexp_extract(l.loan_city, '[0-9]+') AND l.deleted = 'N'""")
def _(i):
    d = rows.active_only(i.dictionary)
    out = rows.decode_embedded_code(i.raw_loans, "loan_city", d, F.col("cnd_group").isin(fv.CITY_GROUPS), "loan_city",
                                    only=F.col("deleted") == "N")
    return out.select("id", "loan_city")


@query("canonical_state", uses="dictionary", sql="""
SELECT id, CASE upper(trim(cnd_name)) """ + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fv.CANONICAL_STATES.items()) + """
       ELSE upper(trim(coalesce(cnd_name, 'unknown'))) END AS state FROM dictionary WHERE cnd_group = 'STATE_INDIA'""")
def _(i):
    return i.dictionary.filter("cnd_group = 'STATE_INDIA'").select("id", text.canonical_state("cnd_name").alias("state"))


@query("normalize_score", uses="tu_scores crif_scores", sql="""
SELECT loanid, created, CASE WHEN cibil_score LIKE '%0-1%' THEN '1' WHEN cibil_score IN ('000','001','002','003','004','005')
       THEN CAST(CAST(cibil_score AS INT) AS VARCHAR) ELSE cibil_score END AS score FROM tu_scores
UNION ALL SELECT loanid, created, CASE WHEN score LIKE '%0-1%' OR score = '' THEN '0' ELSE score END FROM crif_scores""")
def _(i):
    a = i.tu_scores.select("loanid", "created", text.normalize_score("cibil_score").alias("score"))
    return a.unionByName(i.crif_scores.select("loanid", "created", text.normalize_score("score", None, "0", "0").alias("score")))


@query("resolve_month_name_date", uses="bank_months raw_loans", sql=f"""
SELECT b.id, b.month, b.date_cnd, r.cl_created, CAST(try_strptime(
  CAST(CASE WHEN m <= month(cl_created) THEN year(cl_created) ELSE year(cl_created) - 1 END AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-'
  || lpad(regexp_extract(date_cnd, '[0-9]+'), 2, '0'), '%Y-%m-%d') AS DATE) AS day
FROM (SELECT *, instr('Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec', {title_sql('month')}) // 4 + 1 AS m FROM bank_months) b
JOIN (SELECT id, CAST(DATE '1970-01-01' + CAST((created + 19800) // 86400 AS INT) AS DATE) AS cl_created FROM raw_loans) r ON r.id = b.loanid""")
def _(i):
    loans = i.raw_loans.select(F.col("id").alias("loanid"), dates.epoch_to_local_date("created").alias("cl_created"))
    b = i.bank_months.select("id", "loanid", "month", "date_cnd").join(loans, "loanid")
    return b.select("id", "month", "date_cnd", "cl_created", dates.resolve_month_name_date("month", "date_cnd", "cl_created").alias("day"))


@query("extract_decimal", uses="messy_text additional_info", sql="""
SELECT 'info' AS part, id, TRY_CAST(nullif(regexp_extract(value3, '[0-9]+.[0-9]+'), '') AS DECIMAL(10,2)) AS amount FROM additional_info
UNION ALL SELECT 'text', id, TRY_CAST(nullif(regexp_extract(text, '[0-9]+.[0-9]+'), '') AS DECIMAL(10,2)) FROM messy_text""")
def _(i):
    info = i.additional_info.select(F.lit("info").alias("part"), "id", text.extract_decimal("value3").alias("amount"))
    return info.unionByName(i.messy_text.select(F.lit("text").alias("part"), "id", text.extract_decimal("text").alias("amount")))


@query("latest_value", uses="additional_info", sql="""
WITH a AS (SELECT *, CASE WHEN lower(action_type) LIKE '%loan_eligibility_fixed_obligation%' THEN 'o'
                          WHEN lower(action_type) LIKE '%loan_eligibility_monthly_income%' THEN 'i'
                          WHEN lower(action_type) LIKE '%loan_eligibility_debt_service_ratio%' THEN 'r' END AS kind
           FROM additional_info WHERE deleted = 'N'),
     t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY loan_id, kind ORDER BY id DESC) AS rn FROM a WHERE kind IS NOT NULL) WHERE rn = 1)
SELECT k.loan_id, coalesce(o.value2, o.value1) AS total_obligation, coalesce(o.value1, o.value2) AS obligation, o.value3 AS savings,
       coalesce(n.value3, n.value1) AS income, r.value1 AS foir_before, r.value2 AS foir_after
FROM (SELECT DISTINCT loan_id FROM t) k LEFT JOIN t o ON o.loan_id = k.loan_id AND o.kind = 'o'
LEFT JOIN t n ON n.loan_id = k.loan_id AND n.kind = 'i' LEFT JOIN t r ON r.loan_id = k.loan_id AND r.kind = 'r'""")
def _(i):
    return eav_values(i.additional_info)
