"""Channels, representatives, mandates, accounts, people, employment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.q_clean import phone_sql, tokens_sql  # noqa: F401
from checks.registry import query
from lendmart import fixed_values as fv
from lendmart.config import DEFAULT_SITE as SITE
from lendmart.operators import leads as ld
from lendmart.operators import rows
from lendmart.plans import lead_details as lead

D = f"DATE '{views.AS_OF}'"


def day_sql(c, offset=19800):
    return f"CAST(DATE '1970-01-01' + CAST(floor(({c} + {offset}) / 86400) AS INT) AS DATE)"


def title(x):
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END || w[2:]), ' ')"


_E = [f"({c} IS NOT NULL AND {c} <> '')" for c in ("channel", "sub_category", "category")]
CHANNEL_SQL = f"""(SELECT lower(coalesce(channel_source, '')) AS source_key, channel, sub_category, category FROM (SELECT *, row_number() OVER (PARTITION BY lower(channel_source)
  ORDER BY {', '.join(f'{e} DESC' for e in _E)}, channel NULLS LAST, sub_category NULLS LAST, category NULLS LAST) AS rn FROM channel_master) WHERE rn = 1)"""


@query("channel_dimension", uses="channel_master", sql=f"SELECT * FROM {CHANNEL_SQL} c")
def _(i):
    return ld.channel_dimension(i.channel_master)


# Users with an agent label and the channel of their source.
_AGENT = """CASE uid % 11 WHEN 0 THEN 'Fcpartner_Openbank' WHEN 1 THEN 'Fcpartner_Dtpl' WHEN 2 THEN 'Fcpartner_Earnwealth_Solutions' WHEN 3 THEN 'Fcpartner_Parvatiraut'
  WHEN 4 THEN 'Some Agent' WHEN 5 THEN 'Other Agent' END"""
_ATTR = f"""(SELECT u.uid, {_AGENT} AS agent, CASE WHEN u.uid % 13 = 0 THEN 'IMB' ELSE 'X' END AS product, c.channel AS ch, c.sub_category AS sub, c.category AS cat
  FROM raw_users u LEFT JOIN {CHANNEL_SQL} c ON c.source_key = lower(trim(u.source)) AND trim(u.source) <> '')"""


@query("attribute_channel", uses="raw_users channel_master", sql=f"""
WITH o(agent, a, b, c) AS (VALUES ('Fcpartner_Openbank', 'Aggregator', 'Fcpartner_Openbank', 'Aggregator'), ('Fcpartner_Earnwealth_Solutions', 'Aggregator', 'Earnwealth', 'Aggregator'),
  ('Fcpartner_Dtpl', 'Aggregator', 'Droom', 'Aggregator-Two Wheeler'), ('Fcpartner_Parvatiraut', 'DSA Partner', 'Fcpartner_Parvatiraut', 'DSA'))
SELECT uid, CASE WHEN o.a IS NOT NULL THEN o.a WHEN x.agent IS NOT NULL AND coalesce(ch, 'Marketing') = 'Marketing' THEN 'DSA Partner' WHEN product = 'IMB' THEN 'Aggregator' ELSE ch END AS channel,
  CASE WHEN o.b IS NOT NULL THEN o.b WHEN x.agent IS NOT NULL AND coalesce(ch, 'Marketing') IN ('Marketing', 'DSA Partner') THEN x.agent WHEN product = 'IMB' THEN 'IndMoney' ELSE sub END AS sub_category,
  CASE WHEN o.c IS NOT NULL THEN o.c WHEN x.agent IS NOT NULL AND coalesce(ch, 'Marketing') = 'Marketing' THEN 'DSA' WHEN product = 'IMB' THEN 'Aggregator' ELSE cat END AS category
FROM {_ATTR} x LEFT JOIN o ON o.agent = x.agent""")
def _(i):
    dim = ld.channel_dimension(i.channel_master)
    u = i.raw_users.select("uid", "source")
    u = u.join(dim, ld.source_key("source") == dim["source_key"], "left")
    names = ["Fcpartner_Openbank", "Fcpartner_Dtpl", "Fcpartner_Earnwealth_Solutions", "Fcpartner_Parvatiraut", "Some Agent", "Other Agent"]
    agent = None
    for k, n in enumerate(names):
        c = F.col("uid") % 11 == k
        agent = F.when(c, n) if agent is None else agent.when(c, n)
    u = u.withColumn("user_agent_name", agent).withColumn("product_type", F.when(F.col("uid") % 13 == 0, "IMB").otherwise("X"))
    return u.select("uid", *[c.alias(n) for n, c in ld.attribute_channel(SITE).items()])


@query("agent_label", uses="raw_users channel_master", sql=f"""
SELECT uid, CASE WHEN sub = 'Afinoz' THEN 'Afinoz' ELSE agent END AS agent FROM {_ATTR} x""")
def _(i):
    dim = ld.channel_dimension(i.channel_master)
    u = i.raw_users.select("uid", "source").join(dim, ld.source_key("source") == F.col("source_key"), "left")
    names = ["Fcpartner_Openbank", "Fcpartner_Dtpl", "Fcpartner_Earnwealth_Solutions", "Fcpartner_Parvatiraut", "Some Agent", "Other Agent"]
    agent = None
    for k, n in enumerate(names):
        agent = F.when(F.col("uid") % 11 == k, n) if agent is None else agent.when(F.col("uid") % 11 == k, n)
    return u.withColumn("namec_agent", agent).select("uid", ld.agent_label(SITE).alias("agent"))


REPS_SQL = f"""(SELECT value1 AS partner_uid, {title("replace(agent_name, '.', ' ')")} AS rep FROM (
  SELECT *, row_number() OVER (PARTITION BY value1 ORDER BY id DESC) AS rn FROM rep_assignments WHERE deleted = 'N' AND value1 <> 0) WHERE rn = 1)"""
# Names as cleaned for people: tokens out, dots to spaces, title case.
NAMEC = title("trim(regexp_replace(regexp_replace(lower(name), '" + tokens_sql(fv.NAME_STATUS_TOKENS + fv.NAME_DOMAIN_TOKENS) + "', '', 'g'), '\\.', ' ', 'g'))")
MAILC = "replace(trim(regexp_replace(lower(mail), '" + tokens_sql(fv.NAME_STATUS_TOKENS) + "', '', 'g')), '@platform.com1', '@platform.com')"
PEOPLE_SQL = f"""(SELECT l.uid, {title("trim(coalesce(u.fname, '') || ' ' || coalesce(u.lname, ''))")} AS name_user, u.mobile AS mobile_user, u.landline AS landline_user,
  l.name AS namec_org_user, {NAMEC} AS namec_user, l.mail AS email_org_user, {MAILC} AS email_user
  FROM logins l LEFT JOIN raw_users u ON u.uid = l.uid WHERE u.deleted = 'N' OR u.deleted IS NULL)"""
SOURCE_REPS_SQL = f"""(SELECT o.source_name, coalesce(p.namec_user, '') AS rm_others FROM (SELECT lower(old_source) AS source_name, CAST(assigned_to AS BIGINT) AS uid,
  row_number() OVER (PARTITION BY lower(old_source) ORDER BY id DESC) AS rn FROM source_owners) o LEFT JOIN {PEOPLE_SQL} p ON p.uid = o.uid WHERE rn = 1)"""


def people(i):
    return ld.people_dimension(i.logins, i.raw_users, SITE)


@query("people_dimension", uses="logins raw_users", sql=f"SELECT * FROM {PEOPLE_SQL} p")
def _(i):
    return people(i)


@query("agent_reps", uses="rep_assignments", sql=f"SELECT * FROM {REPS_SQL} r")
def _(i):
    return ld.agent_reps(i.rep_assignments)


@query("source_reps", uses="source_owners logins raw_users", sql=f"SELECT * FROM {SOURCE_REPS_SQL} r")
def _(i):
    return ld.source_reps(i.source_owners, people(i))


@query("assign_rep", uses="raw_users rep_assignments source_owners logins", sql=f"""
SELECT u.uid, CASE WHEN s.partner_uid IS NOT NULL THEN s.rep WHEN m.partner_uid IS NOT NULL THEN m.rep WHEN o.rm_others IS NOT NULL THEN o.rm_others
  WHEN u.uid % 5 = 0 THEN 'Call_Center' END AS rm
FROM raw_users u LEFT JOIN {REPS_SQL} s ON s.partner_uid = u.sub_agent_uid AND u.uid % 2 = 0 LEFT JOIN {REPS_SQL} m ON m.partner_uid = u.agent_uid
LEFT JOIN {SOURCE_REPS_SQL} o ON o.source_name = lower(u.source)""")
def _(i):
    u = i.raw_users.select("uid", "agent_uid", "source", F.when(F.col("uid") % 2 == 0, F.col("sub_agent_uid")).alias("sub_agent_uid"),
                           F.lit("x").alias("sub_category"), F.when(F.col("uid") % 5 == 0, "Marketing").alias("channel"))
    return ld.assign_rep(u, ld.agent_reps(i.rep_assignments), ld.source_reps(i.source_owners, people(i)), SITE).select("uid", "rm")


@query("default_portfolio", uses="leads", sql="""
SELECT loan_id, CASE WHEN sub_category = 'Sub0' THEN 'MLP' WHEN r >= DATE '2020-09-01' AND coalesce(source, '') <> 'IMB' THEN 'FD' WHEN r >= DATE '2020-09-01' THEN 'INDMoney' ELSE 'Non-FD' END AS portfolio_type
FROM (SELECT *, loan_registered_date + 9000 AS r FROM leads)""")
def _(i):
    df = i.leads.select("loan_id", "source", F.when(F.col("sub_category") == "Sub0", "MLP").alias("portfolio_type"),
                        F.date_add("loan_registered_date", 9000).alias("cl_created"))
    return df.select("loan_id", ld.default_portfolio(SITE).alias("portfolio_type"))


_PRIO = "CASE " + " ".join(f"WHEN mandate_status IN ({', '.join(repr(x) for x in s)}) THEN {p}" for s, p in fv.MANDATE_PRIORITY) + " END"


def mandate_date_sql(c, strip, repairs):
    fixed = "CASE " + " ".join(f"WHEN {c} = '{a}' THEN '{b}'" for a, b in repairs.items()) + f" ELSE {c} END"
    s = f"regexp_replace({fixed}, '{strip}', '', 'g')"
    eight = f"CASE WHEN length({s}) = 7 THEN '0' || {s} WHEN length({s}) = 8 THEN {s} END"
    return f"CASE WHEN length({s}) = 10 THEN {day_sql(f'TRY_CAST({s} AS BIGINT)')} WHEN regexp_matches({eight}, '^[0-9]{{8}}$') THEN CAST(try_strptime({eight}, '%d%m%Y') AS DATE) END"


BEST_SQL = f"""(SELECT loan_id, unique_reference_no AS mandate_id, prio AS nach_priority, {day_sql('created')} AS nach_created,
  {mandate_date_sql('startdate', '[^0-9]', fv.START_DATE_REPAIRS)} AS nach_start_date, {mandate_date_sql('enddate', '-|/', fv.END_DATE_REPAIRS)} AS nach_end_date,
  CASE WHEN account_type = '10' THEN 'Saving' ELSE 'Current' END AS nach_account_type,
  CASE WHEN mandate_status = 'Final Approved' THEN '' WHEN prio = 7 AND lower(rejected_reason) LIKE '%invalid umrn or inactive mandate%' THEN 'Invalid Umrn Or Inactive Mandate'
       WHEN prio = 7 AND lower(rejected_reason) LIKE '%activat%' THEN 'Deactivation Request' ELSE {title("trim(coalesce(rejected_reason, ''))")} END AS nach_reason,
  CASE WHEN prio = 7 THEN 'Deactivated' ELSE {title("trim(coalesce(mandate_status, ''))")} END AS nach_status
FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY prio DESC NULLS LAST, unique_reference_no) AS rn FROM (SELECT *, {_PRIO} AS prio FROM mandates WHERE deleted = 'N')) WHERE rn = 1)"""
BEST_COLUMNS = ["loan_id", "mandate_id", "nach_priority", "nach_created", "nach_start_date", "nach_end_date", "nach_account_type", "nach_reason", "nach_status"]


@query("best_mandate", uses="mandates", sql=f"SELECT * FROM {BEST_SQL} b")
def _(i):
    return ld.best_mandate(i.mandates).select(*BEST_COLUMNS)


_OK = """(upper(cf_status) IN ('ACTIVE', 'BANK_APPROVAL_PENDING', 'ERROR') AND (lower(cf_message) IN ('subscription activated successfully', 'subscription authorised successfully')
  OR upper(cf_message) LIKE '%SUBSCRIPTION_ALREADY_EXIST%'))"""
SUBS_SQL = f"""(SELECT loan_id, mandate_id, count(*) AS mandate_link_created, max(CASE WHEN {_OK} THEN 1 ELSE 0 END) AS mandate_active, min(d) AS enach_first_link_created_date,
  max(CASE WHEN {_OK} THEN d END) AS enach_active_subscription_date FROM (SELECT DISTINCT loan_id, unique_reference_no AS mandate_id, cf_message, cf_status, bank_holder_name, account_no,
  {day_sql('created', 0)} AS d FROM subscriptions WHERE deleted = 'N' AND status = 'OK') GROUP BY loan_id, mandate_id)"""
BANK_SQL = f"""(SELECT loan_id, mandate_id, count(*) AS icici_mandate_link_created, max(CASE WHEN state = 'Y' AND status = '0300' THEN 1 ELSE 0 END) AS icici_mandate_active, min(d) AS icici_mandate_first_created_date,
  max(CASE WHEN state = 'Y' AND status = '0300' THEN d END) AS icici_mandate_active_date FROM (SELECT DISTINCT loan_id, mandate_id, state, status, reason, {day_sql('created', 0)} AS d FROM bank_mandates WHERE deleted = 'N') GROUP BY loan_id, mandate_id)"""


@query("subscription_counts", uses="subscriptions", sql=f"SELECT * FROM {SUBS_SQL} s")
def _(i):
    return ld.subscription_counts(i.subscriptions)


@query("bank_mandate_counts", uses="bank_mandates", sql=f"SELECT * FROM {BANK_SQL} s")
def _(i):
    return ld.bank_mandate_counts(i.bank_mandates)


STATUS_SQL = f"""(SELECT b.*, s.mandate_active, k.icici_mandate_active, CASE WHEN coalesce(mandate_link_created, 0) + coalesce(icici_mandate_link_created, 0) > 0 THEN 'E-Mandate' ELSE 'Nach' END AS nach_source,
  CASE (nach_status = 'Final Approved') WHEN TRUE THEN CASE WHEN coalesce(mandate_active, 0) + coalesce(icici_mandate_active, 0) > 0 THEN 'E-Mandate Activated' ELSE 'Nach Activated' END
       ELSE CASE WHEN coalesce(mandate_active, 0) + coalesce(icici_mandate_active, 0) > 0 THEN 'E-Mandate Authorised' ELSE 'No E-Mandate & Nach' END END AS mandate_status
FROM {BEST_SQL} b LEFT JOIN {SUBS_SQL} s ON s.loan_id = b.loan_id AND s.mandate_id = b.mandate_id LEFT JOIN {BANK_SQL} k ON k.loan_id = b.loan_id AND k.mandate_id = b.mandate_id)"""


def status(i):
    return ld.mandate_status(ld.best_mandate(i.mandates), ld.subscription_counts(i.subscriptions), ld.bank_mandate_counts(i.bank_mandates))


@query("mandate_status", uses="mandates subscriptions bank_mandates", sql=f"SELECT loan_id, mandate_id, nach_source, mandate_status FROM {STATUS_SQL} s")
def _(i):
    return status(i).select("loan_id", "mandate_id", "nach_source", "mandate_status")


@query("registration_method", uses="mandates subscriptions bank_mandates cheques", sql=f"""
WITH m AS (SELECT s.*, c.n, CASE WHEN nach_status = 'Final Approved' AND coalesce(nach_end_date, DATE '9999-12-31') >= DATE '1998-06-30' THEN mandate_status WHEN c.n > 1 THEN 'PDC' ELSE 'Online' END AS method
  FROM {STATUS_SQL} s LEFT JOIN (SELECT loan_id, sum(CASE WHEN cheque_status = 'Pending' THEN 1 ELSE 0 END) AS n FROM cheques WHERE deleted = 'N' GROUP BY loan_id) c ON c.loan_id = s.loan_id)
SELECT loan_id, method AS payment_registration_method, CASE WHEN method = 'PDC' THEN 'Reliable Data Services' WHEN method = 'Online' THEN 'Not Known' WHEN icici_mandate_active = 1 THEN 'E-MANDATE thru ICICI'
  WHEN mandate_active = 1 THEN 'E-MANDATE thru CASHFREE' ELSE 'MANDATE - Manual' END AS payment_registration_vendor FROM m""")
def _(i):
    df = status(i).join(ld.cheque_counts(i.cheques), "loan_id", "left")
    return df.select("loan_id", *[c.alias(n) for n, c in ld.registration_method(views.AS_OF).items()])


@query("deviation_counts", uses="additional_info", sql="""
WITH d AS (SELECT DISTINCT loan_id, value1 AS code, """ + day_sql("created", 0) + """ AS day, CAST(created_by AS BIGINT) AS who FROM additional_info
           WHERE deleted = 'N' AND action_type IN ('borrower_deviation', 'borrower_deviation_new'))
SELECT loan_id, 'Y' AS dev_exists, count(*) AS total_dev, arg_max(who, (day, code)) AS dev_created_by, """ + ", ".join(
    f"CAST(sum(CASE WHEN code IN ({', '.join(repr(c) for c in codes)}) THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, _, codes in fv.DEVIATION_CLASSES) + " FROM d GROUP BY loan_id")
def _(i):
    return ld.deviation_counts(i.additional_info)


@query("primary_account", uses="bank_accounts raw_loans", sql="""
SELECT uid, account_name, account_number, upper(account_ifsc_number) AS account_ifsc, CASE WHEN account_type IN ('10', 'Fixed', 'Salaried', 'Saving', 'saving') THEN 'Saving'
  WHEN account_type IN ('11', '13', 'Current', 'current', 'Over_draft') THEN 'Current' ELSE '' END AS account_type, branch_add, bank_name, micr_number
FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY created DESC, account_number) AS rn FROM bank_accounts WHERE deleted = 'N' AND uid IN (SELECT uid FROM raw_loans WHERE deleted = 'N')) WHERE rn = 1""")
def _(i):
    return ld.primary_account(i.bank_accounts, i.raw_loans)


@query("lead_flags", uses="bureau_ignore raw_loans", sql="""
SELECT * FROM (SELECT id AS loan_id, CASE WHEN id IN (SELECT loan_id FROM bureau_ignore WHERE deleted = 'N' AND remark IS NULL) THEN 1 ELSE 0 END AS fraud_flag,
  CASE WHEN id IN (SELECT loan_id FROM bureau_ignore WHERE deleted = 'N') THEN 1 ELSE 0 END AS ignore_flag,
  CASE WHEN settlement_term = 1 AND deleted = 'N' THEN 1 ELSE 0 END AS ex360_npa FROM raw_loans) WHERE fraud_flag + ignore_flag + ex360_npa > 0""")
def _(i):
    return ld.lead_existence_flags(i.bureau_ignore, i.raw_loans)


@query("disposition", uses="raw_users dictionary", sql="SELECT uid, CASE WHEN d.cnd_name IS NULL AND plus IN (0, 30) THEN '' " + " ".join(
    f"WHEN plus = {k} THEN '{v}'" for k, v in fv.DISPOSITION_OVERRIDES.items()) + """ ELSE d.cnd_name END AS call_disposition
FROM raw_users u LEFT JOIN (SELECT * FROM dictionary WHERE cnd_group = 'DISPOSITION' AND deleted = 'N') d ON d.cnd_code = CAST(u.plus AS VARCHAR)""")
def _(i):
    u = rows.decode(i.raw_users.select("uid", "plus"), "plus", rows.active_only(i.dictionary), "DISPOSITION", "disp_name", key="cnd_code", unique=False)
    return u.select("uid", ld.disposition().alias("call_disposition"))


def _label(group, code):
    return f"(SELECT coalesce(d.cnd_name, 'unknown') FROM dictionary d WHERE d.deleted = 'N' AND d.cnd_group = '{group}' AND d.id = {code})"


@query("user_profile", uses="raw_users logins dictionary", sql=f"""
SELECT u.uid, a.namec_user AS namec_agent, a.mobile_user AS mobile_agent, s.name_user AS name_sub_agent, j.email_user AS email_jobassigned, m.namec_user AS namec_portfolio_manager, me.email_user,
  {title('trim(' + _label('INDIA_RELIGION', 'u.religion_cnd') + ')')} AS religion, {title('trim(' + _label('INDIA_MOTHERTONGUE', 'u.mothertounge_cnd') + ')')} AS mothertounge,
  CASE upper({_label('STATE_INDIA', 'u.origin_state_cnd')}) WHEN 'TAMILNADU' THEN 'TAMIL NADU' ELSE upper({_label('STATE_INDIA', 'u.origin_state_cnd')}) END AS origion_state,
  {day_sql('u.dob')} AS cu_dob, {day_sql('u.created')} AS cu_created
FROM raw_users u LEFT JOIN {PEOPLE_SQL} a ON a.uid = u.agent_uid LEFT JOIN {PEOPLE_SQL} s ON s.uid = u.sub_agent_uid LEFT JOIN {PEOPLE_SQL} j ON j.uid = u.job_assigning
LEFT JOIN {PEOPLE_SQL} m ON m.uid = u.portfolio_manager LEFT JOIN {PEOPLE_SQL} me ON me.uid = u.uid""")
def _(i):
    return ld.user_profile(i.raw_users, people(i), rows.active_only(i.dictionary)).select(
        "uid", "namec_agent", "mobile_agent", "name_sub_agent", "email_jobassigned", "namec_portfolio_manager", "email_user", "religion", "mothertounge",
        "origion_state", "cu_dob", "cu_created")


def _dec(group, code):
    return f"coalesce((SELECT d.cnd_name FROM dictionary d WHERE d.deleted = 'N' AND d.cnd_group = '{group}' AND CAST(d.id AS VARCHAR) = CAST({code} AS VARCHAR)), CAST({code} AS VARCHAR))"


def _tt(x, default=""):
    return title(f"trim(coalesce({x}, '{default}'))")


_START = "CASE WHEN comp_start = '6309528114600' THEN 1577491200 ELSE TRY_CAST(comp_start AS BIGINT) END"


@query("employment_profile", uses="employment dictionary geo", sql=f"""
WITH e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY id DESC) AS rn FROM employment WHERE deleted = 'N') WHERE rn = 1)
SELECT e.uid, {_tt(_dec('EMPLOYMENT_TYPE', 'employment_type_cnd'), 'unknown')} AS employement_type, {_tt('comp_name', 'unknown')} AS comp_name, {_tt('g.city_pin', 'unknown')} AS comp_city,
  {_tt('g.state', 'unknown')} AS comp_state, regexp_extract(comp_pin, '[0-9]+') AS comp_pin, lower(trim(comp_email)) AS comp_email, {day_sql(_START)} AS comp_startdate,
  {day_sql('TRY_CAST(comp_end AS BIGINT)')} AS com_enddate, CASE comp_business_type_cnd WHEN 90000116 THEN '' ELSE '55' END AS comp_businesstype,
  {_tt(_dec('INDIA_PROFESSION', 'comp_industry_cnd'))} AS comp_industry, {_tt(_dec('INDIA_PROFESSION', 'profession_cnd'))} AS comp_profession,
  CASE office_type WHEN '1' THEN 'Owned' WHEN '0' THEN 'Rented' ELSE '' END AS comp_officetype,
  CASE WHEN industry_type = '60' THEN 'Other' ELSE {_tt(_dec('business_industry_type_new', 'industry_type'))} END AS comp_industrytype
FROM e LEFT JOIN geo g ON CAST(g.pincode AS VARCHAR) = regexp_extract(comp_pin, '[0-9]+')""")
def _(i):
    return ld.employment_profile(i.employment, rows.active_only(i.dictionary), i.geo).select(
        "uid", "employement_type", "comp_name", "comp_city", "comp_state", "comp_pin", "comp_email", "comp_startdate", "com_enddate", "comp_businesstype",
        "comp_industry", "comp_profession", "comp_officetype", "comp_industrytype")


@query("identity_frame", uses="identity_addresses", sql=f"""
SELECT loan_id, coalesce({title("trim(regexp_replace(name, 'null', '', 'g'))")}, '') AS adhaar_name, coalesce({title("trim(vtc)")}, '') AS adhaar_vtc, '' AS adhaar_street, '' AS adhaar_adhaar
FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY id DESC) AS rn FROM identity_addresses WHERE deleted = 'N') WHERE rn = 1""")
def _(i):
    return lead.identity_frame(i.identity_addresses).select("loan_id", "adhaar_name", "adhaar_vtc", "adhaar_street", "adhaar_adhaar")


@query("bank_balance", uses="bank_months raw_loans", sql=f"""
WITH b AS (SELECT b.loanid, b.monthly_amount, CAST(try_strptime(CAST(CASE WHEN m <= month(c) THEN year(c) ELSE year(c) - 1 END AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-'
    || lpad(regexp_extract(date_cnd, '[0-9]+'), 2, '0'), '%Y-%m-%d') AS DATE) AS d
  FROM (SELECT *, instr('Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec', {title('month')}) // 4 + 1 AS m FROM bank_months WHERE deleted = 'N') b
  JOIN (SELECT id, {day_sql('created')} AS c FROM raw_loans) l ON l.id = b.loanid)
SELECT loanid AS loan_id, round(avg(a), 3) AS monthly_average_balance FROM (SELECT loanid, a, row_number() OVER (PARTITION BY loanid ORDER BY m DESC NULLS LAST) AS rn
  FROM (SELECT loanid, date_trunc('month', d) AS m, avg(CAST(monthly_amount AS DOUBLE)) AS a FROM b GROUP BY ALL)) WHERE rn <= 3 GROUP BY loanid""")
def _(i):
    loans = i.raw_loans.select(F.col("id").alias("loan_id"), lead.epoch_to_local_date("created").alias("cl_created"))
    months = i.bank_months.withColumn("monthly_amount", F.col("monthly_amount").cast("double"))
    return lead.bank_balance(months, loans).withColumn("monthly_average_balance", F.round("monthly_average_balance", 3))


@query("detail_frame", uses="loan_detail dictionary", sql=f"""
SELECT loan_id, CASE residence_type_cnd WHEN 1 THEN 'Rented' WHEN 2 THEN 'Self Owned' WHEN 3 THEN 'Owned By Parent Or Sibling' WHEN 4 THEN 'Relatives'
  ELSE {title("coalesce(d.cnd_name, 'unknown')")} END AS residence_type, {day_sql('TRY_CAST(residence_shifting_date AS BIGINT)')} AS residence_shifting_date,
  {', '.join('l.' + c for c in lead.LOAN_DETAIL_COLUMNS)}
FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY id DESC) AS rn FROM loan_detail) l LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group = 'RESIDENCE_TYPE') d
ON d.id = l.residence_type_cnd WHERE rn = 1 AND l.deleted = 'N'""")
def _(i):
    return lead.detail_frame(i.loan_detail, rows.active_only(i.dictionary))


def _rate(code):
    return f"(SELECT CAST(trim(replace(d.cnd_name, '%', '')) AS DECIMAL(10,2)) FROM dictionary d WHERE d.deleted = 'N' AND d.cnd_group = 'INTREST_RATE' AND d.id = l.{code})"


@query("loan_base", uses="raw_loans dictionary", sql=f"""
SELECT l.id AS loan_id, {title("trim(s.cnd_name)")} AS loan_currentstate, t.cnd_name AS loan_type, {_rate('loan_irate_expected')} AS rate_expected, {_rate('min_irate_apporved')} AS rate_min_approved,
  {_rate('max_irate_approved')} AS rate_max_approved, CASE loan_sub_state WHEN 714 THEN 'FINAL APPROVE' WHEN 1 THEN 'Not Contactable/Not reachable' END AS loan_sub_staus,
  {day_sql('created')} AS cl_created, CASE WHEN live_date <> 0 THEN {day_sql('live_date')} END AS live_date, coalesce(c.cnd_name, l.loan_city) AS loan_city
FROM raw_loans l LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group = 'LOAN_STATE') s ON s.cnd_code = l.loan_state
LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group = 'INDIA_LOAN') t ON t.id = l.loan_type_cnd
LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group IN ('LOAN_CITY', 'STATE_INDIA')) c ON CAST(c.id AS VARCHAR) = regexp_extract(l.loan_city, '[0-9]+') AND l.deleted = 'N'""")
def _(i):
    from checks.q_marts import catalog
    return lead.loan_base(catalog(i), rows.active_only(i.dictionary)).select("loan_id", "loan_currentstate", "loan_type", "rate_expected", "rate_min_approved", "rate_max_approved", "loan_sub_staus",
                                             "cl_created", "live_date", "loan_city")


@query("log_frame", uses="log uw_master", sql=f"""
SELECT entity AS loan_id, {', '.join(f"max(CASE WHEN entity_type = '{t}' AND new_state IN ({', '.join(map(str, s))}) THEN at_s END) AS {n}" for n, (t, s) in fv.MILESTONES.items())},
  arg_max(actor, (at_s, id)) FILTER (WHERE entity_type = 'cent_loan' AND new_state = 1050 AND actor NOT IN (0, 1)) AS ba_uid,
  arg_max(actor, (at_s, id)) FILTER (WHERE entity_type = 'cent_loan' AND actor NOT IN (0, 1) AND ((old_state = 1050 AND new_state = 1200) OR (old_state = 1200 AND new_state IN (1400, 1100)))) AS preuw_uid,
  min(at_s) FILTER (WHERE entity_type = 'cent_loan' AND new_state = 1400) AS uwac_created,
  arg_max(actor, (at_s, id)) FILTER (WHERE mv) AS uw_last, max(at_s) FILTER (WHERE mv) AS uw_last_at,
  {', '.join(f"arg_max(actor, (at_s, id)) FILTER (WHERE mv AND new_state = {s}) AS uw_{n}, max(at_s) FILTER (WHERE mv AND new_state = {s}) AS uw_{n}_date" for n, s in fv.UW_SLOTS.items())}
FROM (SELECT *, entity_type = 'cent_loan' AND old_state IN (1400, 1500, 1700) AND new_state IN (-1000, 1100, 1500, 1600, 2500, 2700) AND actor NOT IN (0, 1)
        AND actor IN (SELECT uw_id FROM uw_master) AS mv FROM log) GROUP BY entity""")
def _(i):
    from lendmart.operators import state_log as sl
    out = lead.log_frame(sl.state_log(i.state_log), i.uw_master, SITE)
    times = [*fv.MILESTONES, "uwac_created", "uw_last_at", *[f"uw_{n}_date" for n in fv.UW_SLOTS]]
    return out.select(*[F.unix_seconds(c).alias(c) if c in times else F.col(c) for c in out.columns])
