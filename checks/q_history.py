"""Latest rows, history, state log and rule outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from lendmart import fixed_values as fv
from lendmart.functions import bands
from lendmart.functions.dates import epoch_to_local_date
from lendmart.functions.text import normalize_score
from lendmart.operators import rows
from lendmart.operators import state_log as sl
from lendmart.plans import lead_details as lead

LOAN = "entity_type = 'cent_loan'"
MOVES = f"""(SELECT g.* FROM log g WHERE {LOAN} AND old_state IN (1400, 1500, 1700) AND new_state IN (-1000, 1100, 1500, 1600, 2500, 2700)
  AND actor NOT IN (0, 1) AND actor IN (SELECT uw_id FROM uw_master))"""


def log(i):
    return sl.state_log(i.state_log)


def moves(i):
    return sl.underwriting_moves(log(i), i.uw_master)


def seconds(c, name="at_s"):
    return F.unix_seconds(c).alias(name)


@query("latest_by", sql="""
SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def _(i):
    return rows.latest_by(i.orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select(
        "o_custkey", "o_orderkey", "o_orderpriority")


@query("state_log", uses="log", sql="SELECT id, entity, entity_type, old_state, new_state, actor, at_s FROM log")
def _(i):
    return log(i).select("id", "entity", "entity_type", "old_state", "new_state", "actor", seconds("at"))


@query("last_actor", uses="log", sql=f"""
SELECT entity, actor, at_s FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY at_s DESC, id DESC) AS rn FROM log
  WHERE {LOAN} AND actor NOT IN (0, 1) AND ((old_state = 1050 AND new_state = 1200) OR (old_state = 1200 AND new_state IN (1400, 1100)))) WHERE rn = 1""")
def _(i):
    return sl.last_actor(log(i), fv.PREUW_TRANSITIONS).select("entity", "actor", seconds("at"))


@query("last_actor_per_state", uses="log uw_master", sql=f"""
SELECT entity, new_state, actor, at_s FROM (SELECT *, row_number() OVER (PARTITION BY entity, new_state ORDER BY at_s DESC, id DESC) AS rn FROM {MOVES} m) WHERE rn = 1""")
def _(i):
    return sl.last_actor_per_state(moves(i)).select("entity", "new_state", "actor", seconds("at"))


@query("first_entry", uses="log", sql=f"SELECT entity, min(at_s) AS at_s FROM log WHERE {LOAN} AND new_state = 1400 GROUP BY entity")
def _(i):
    return sl.first_entry(log(i), 1400).select("entity", seconds("at"))


@query("latest_milestones", uses="log", sql="SELECT entity, " + ", ".join(
    f"max(CASE WHEN entity_type = '{t}' AND new_state IN ({', '.join(map(str, s))}) THEN at_s END) AS {n}"
    for n, (t, s) in fv.MILESTONES.items()) + " FROM log GROUP BY entity")
def _(i):
    return sl.latest_milestones(log(i)).select("entity", *[seconds(n, n) for n in fv.MILESTONES])


@query("actors_wide", uses="log uw_master", sql=f"""
WITH m AS (SELECT *, row_number() OVER (PARTITION BY entity, new_state ORDER BY at_s DESC, id DESC) AS per_state,
                  row_number() OVER (PARTITION BY entity ORDER BY at_s DESC, id DESC) AS overall FROM {MOVES} m)
SELECT entity, max(CASE WHEN overall = 1 THEN actor END) AS uw_last, max(at_s) AS uw_last_at, """ + ", ".join(
    f"max(CASE WHEN new_state = {s} AND per_state = 1 THEN actor END) AS uw_{n}, max(CASE WHEN new_state = {s} THEN at_s END) AS uw_{n}_date"
    for n, s in fv.UW_SLOTS.items()) + " FROM m GROUP BY entity")
def _(i):
    out = sl.actors_wide(moves(i))
    return out.select("entity", "uw_last", seconds("uw_last_at", "uw_last_at"),
                      *[c for n in fv.UW_SLOTS for c in (F.col(f"uw_{n}"), seconds(f"uw_{n}_date", f"uw_{n}_date"))])


ALLOC = """(SELECT loan_id, uwas_id, at_s FROM (
  SELECT l.id AS loan_id, TRY_CAST(regexp_extract(s.remark, 'agent- (.*?) ', 1) AS BIGINT) AS uwas_id, s.created + 19800 AS at_s,
         row_number() OVER (PARTITION BY l.id ORDER BY s.id DESC) AS rn
  FROM job_log j JOIN job_steps s ON s.cron_id = j.cron_id JOIN raw_loans l ON CAST(l.uid AS VARCHAR) = s.communication_id
  WHERE s.status = 'success' AND j.cron_type LIKE 'automatic_allocation%') WHERE rn = 1)"""


@query("parsed_allocation", uses="job_log job_steps raw_loans", sql=f"SELECT * FROM {ALLOC} a")
def _(i):
    return sl.parsed_allocation(i.job_log, i.job_steps, i.raw_loans).select("loan_id", "uwas_id", seconds("uwas_assigned_date"))


@query("assigned_actor", uses="job_log job_steps raw_loans log uw_master", sql=f"""
SELECT l.id AS loan_id, coalesce(a.uwas_id, w.actor) AS uw_assigned_id, coalesce(a.at_s, e.at_s, w.at_s) AS uw_assigned_date,
  CAST(last_day(DATE '1970-01-01' + CAST(coalesce(a.at_s, e.at_s, w.at_s) // 86400 AS INT)) AS DATE) AS uw_lastday_assigned_date
FROM raw_loans l LEFT JOIN {ALLOC} a ON a.loan_id = l.id
LEFT JOIN (SELECT entity, actor, at_s FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY at_s DESC, id DESC) AS rn FROM {MOVES} m) WHERE rn = 1) w ON w.entity = l.id
LEFT JOIN (SELECT entity, min(at_s) AS at_s FROM log WHERE {LOAN} AND new_state = 1400 GROUP BY entity) e ON e.entity = l.id
WHERE coalesce(a.uwas_id, w.actor) IS NOT NULL""")
def _(i):
    df = i.raw_loans.select(F.col("id").alias("loan_id"))
    df = df.join(sl.parsed_allocation(i.job_log, i.job_steps, i.raw_loans), "loan_id", "left")
    df = df.join(sl.actors_wide(moves(i)).withColumnRenamed("entity", "loan_id"), "loan_id", "left")
    df = df.join(sl.first_entry(log(i), 1400).select(F.col("entity").alias("loan_id"), F.col("at").alias("uwac_created")), "loan_id", "left")
    return sl.assigned_actor(df).select("loan_id", "uw_assigned_id", seconds("uw_assigned_date", "uw_assigned_date"), "uw_lastday_assigned_date")


# Optional event times per user, as days so that ties occur.
_EVENTS = """(SELECT user_id, min(CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) END) AS uw_assigned_date,
  max(CASE WHEN event_type = 'view' AND event_id % 7 = 0 THEN CAST(ts AS DATE) END) AS uw_returned_date,
  max(CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN CAST(ts AS DATE) END) AS uw_forward_to_cs_date,
  max(CASE WHEN event_type = 'error' AND event_id % 6 = 0 THEN CAST(ts AS DATE) END) AS uw_cancelled_date,
  max(CASE WHEN event_type = 'signup' AND event_id % 4 = 0 THEN CAST(ts AS DATE) END) AS uw_live_date,
  max(CASE WHEN event_type = 'click' AND event_id % 9 = 0 THEN CAST(ts AS DATE) END) AS rfd_date,
  max(CASE WHEN event_type = 'view' AND event_id % 11 = 0 THEN CAST(ts AS DATE) END) AS delist_date,
  max(CASE WHEN event_type = 'purchase' AND event_id % 17 = 0 THEN CAST(ts AS DATE) END) AS first_disburse_date FROM events GROUP BY user_id)"""


def event_frame(i):
    def last(kind, mod, name):
        return F.max(F.when((F.col("event_type") == kind) & (F.col("event_id") % mod == 0), F.to_date("ts"))).alias(name)
    return i.events.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "click", F.to_date("ts"))).alias("uw_assigned_date"),
        last("view", 7, "uw_returned_date"), last("purchase", 5, "uw_forward_to_cs_date"), last("error", 6, "uw_cancelled_date"),
        last("signup", 4, "uw_live_date"), last("click", 9, "rfd_date"), last("view", 11, "delist_date"),
        last("purchase", 17, "first_disburse_date")).select(
        "*", F.lit("assigned").alias("uw_name"), *[F.lit(n).alias(f"uw_{n}") for n in fv.UW_SLOTS],
        F.when(F.col("user_id") % 10 == 0, "IMB").otherwise("X").alias("product_type"),
        F.when(F.col("user_id") % 3 == 0, "Cancelled").otherwise("Live").alias("loan_currentstate"))


# The winner is found by ranking the dated events, not by a chain of comparisons.
@query("resolve_latest_event", sql=f"""
WITH e AS (SELECT * FROM {_EVENTS} x),
c AS (SELECT user_id, 'returned' AS k, uw_returned_date AS d FROM e UNION ALL SELECT user_id, 'forward_to_cs', uw_forward_to_cs_date FROM e
      UNION ALL SELECT user_id, 'cancelled', uw_cancelled_date FROM e UNION ALL SELECT user_id, 'live', uw_live_date FROM e),
t AS (SELECT user_id, max(d) AS d, count(d) AS n FROM c GROUP BY user_id),
w AS (SELECT c.user_id, max(c.k) AS k, max(c.d) AS d, count(*) AS ties FROM c JOIN t ON t.user_id = c.user_id AND t.d = c.d GROUP BY c.user_id),
r AS (SELECT e.*, t.n, w.k, w.d AS top,
  CASE WHEN w.ties = 1 AND w.d >= e.uw_assigned_date AND (w.k = 'live' OR e.rfd_date IS NULL OR e.rfd_date < w.d) THEN w.k END AS win,
  coalesce(e.rfd_date >= e.uw_assigned_date OR (e.rfd_date IS NOT NULL AND e.first_disburse_date IS NOT NULL), FALSE) AS ready,
  coalesce(e.delist_date >= e.uw_assigned_date AND e.user_id % 3 = 0 AND e.uw_live_date IS NOT NULL, FALSE) AS dropped
  FROM e LEFT JOIN t ON t.user_id = e.user_id LEFT JOIN w ON w.user_id = e.user_id)
SELECT user_id, CASE WHEN user_id % 10 = 0 THEN 'UW Not Assigned' WHEN n > 0 AND win IS NOT NULL THEN win
         WHEN uw_assigned_date IS NULL THEN 'UW Not Assigned' ELSE 'assigned' END AS uw_name_final,
  CASE WHEN user_id % 10 = 0 THEN 'UW Not Assigned' WHEN n > 0 AND win = 'returned' THEN 'Returned' WHEN n > 0 AND win = 'forward_to_cs' THEN 'Forward to CS'
       WHEN n > 0 AND win = 'cancelled' THEN 'Cancelled' WHEN n > 0 AND (win = 'live' OR ready) THEN 'Live' WHEN n > 0 AND dropped THEN 'Cancelled'
       WHEN uw_assigned_date IS NULL THEN 'UW Not Assigned' ELSE 'Assigned' END AS uw_status_final,
  CASE WHEN user_id % 10 = 0 THEN NULL WHEN n > 0 AND win IS NOT NULL THEN top WHEN n > 0 AND ready THEN rfd_date WHEN n > 0 AND dropped THEN delist_date
       ELSE uw_assigned_date END AS uw_updated_date FROM r""")
def _(i):
    return event_frame(i).select("user_id", *[c.alias(n) for n, c in sl.resolve_latest_event().items()])


_DAILY = """(SELECT loan_id, min(CASE WHEN bad = 0 THEN day END) AS rule_pass_date, min(CASE WHEN bad > 0 THEN day END) AS rule_reject_date
  FROM (SELECT loan_id, CAST(DATE '1970-01-01' + CAST((created + 19800) // 86400 AS INT) AS DATE) AS day,
               sum(CASE WHEN status IN ('Reject', 'REJECTED', 'REJECT') THEN 1 ELSE 0 END) AS bad
        FROM rule_runs WHERE deleted = 'N' AND (action_type IS NULL OR action_type <> 'OTHER') GROUP BY ALL) GROUP BY loan_id)"""
_WINDOW = f"""(SELECT r.*, m.first_disburse_date,
  CASE WHEN rule_pass_date >= DATE '2024-01-02' AND (m.first_disburse_date IS NULL OR rule_pass_date <= m.first_disburse_date) THEN rule_pass_date END AS p,
  CASE WHEN rule_reject_date >= DATE '2024-01-02' AND (m.first_disburse_date IS NULL OR rule_reject_date <= m.first_disburse_date) THEN rule_reject_date END AS q
  FROM {_DAILY} r LEFT JOIN milestone m ON m.loanid = r.loan_id)"""


def outcome(i):
    return sl.daily_rule_outcome(i.rule_runs, fv.RULE_ACTIONS)


def windowed(i):
    df = outcome(i).join(i.milestone, F.col("loan_id") == F.col("loanid"), "left").withColumn("registered", F.lit("2024-01-02").cast("date"))
    flags = sl.rule_window_flags("registered", "first_disburse_date")
    return df.select("loan_id", "first_disburse_date", *[c.alias(n) for n, c in flags.items()])


@query("daily_rule_outcome", uses="rule_runs", sql=f"SELECT * FROM {_DAILY} d")
def _(i):
    return outcome(i)


@query("rule_window_flags", uses="rule_runs milestone", sql=f"""
SELECT loan_id, CASE WHEN p IS NOT NULL THEN 1 END AS rule_pass, p AS rule_pass_date, CASE WHEN q IS NOT NULL THEN 1 END AS rule_reject, q AS rule_reject_date
FROM {_WINDOW} w""")
def _(i):
    return windowed(i).drop("first_disburse_date")


@query("prequal_flags", uses="rule_runs milestone", sql=f"""
SELECT loan_id, CASE WHEN d OR pre OR p IS NOT NULL OR q IS NOT NULL THEN 1 ELSE 0 END AS rule_executed_flag,
  CASE WHEN d OR pre THEN 1 WHEN p IS NOT NULL THEN CASE WHEN coalesce(q <= p, TRUE) THEN 1 ELSE 0 END WHEN q IS NOT NULL THEN 0 END AS pq_approved_flag,
  CASE WHEN d AND mx IS NULL THEN first_disburse_date WHEN d AND first_disburse_date <= mx THEN first_disburse_date WHEN d OR pre THEN mx
       WHEN p IS NOT NULL AND coalesce(q <= p, TRUE) THEN p END AS pq_approved_date
FROM (SELECT *, first_disburse_date IS NOT NULL AS d, loan_id % 4 = 0 AS pre, CASE WHEN p IS NULL THEN q WHEN q IS NULL OR q < p THEN p ELSE q END AS mx FROM {_WINDOW} w) x""")
def _(i):
    df = windowed(i).withColumn("loan_img1", F.when(F.col("loan_id") % 4 == 0, "REFER"))
    return df.select("loan_id", *[c.alias(n) for n, c in sl.prequal_flags().items()])


_KNOWN = ", ".join(f"'{a}'" for a, _, _ in fv.LENDER_RULES)
_LATEST = f"""(SELECT loan_id, action_type, CAST(DATE '1970-01-01' + CAST(created // 86400 AS INT) AS DATE) AS rule_date, CASE WHEN final_value = '1000' THEN 1 ELSE 0 END AS bre_pass
  FROM (SELECT *, row_number() OVER (PARTITION BY loan_id, action_type ORDER BY created DESC, id DESC) AS rn FROM lender_rule_log WHERE deleted = 'N' AND action_type IN ({_KNOWN})) WHERE rn = 1)"""
PIVOT_SQL = "(SELECT loan_id, min(rule_date) AS bre_date, " + ", ".join(
    f"CAST(sum(CASE WHEN action_type = '{a}' THEN bre_pass END) AS BIGINT) AS {n}" for a, _, n in fv.LENDER_RULES) + f" FROM {_LATEST} l GROUP BY loan_id)"


@query("latest_rule_by_type", uses="lender_rule_log", sql="SELECT loan_id, rule_date, bre_pass, CASE action_type " + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b, _ in fv.LENDER_RULES) + f" END AS lender_name FROM {_LATEST} l")
def _(i):
    return sl.latest_rule_by_type(i.lender_rule_log)


@query("pivot_outcomes", uses="lender_rule_log", sql=f"SELECT * FROM {PIVOT_SQL} p")
def _(i):
    return sl.pivot_outcomes(sl.latest_rule_by_type(i.lender_rule_log))


_REASONS = """(SELECT loan_id, string_agg(v, '|' ORDER BY v) AS ops_reason FROM (SELECT DISTINCT a.loan_id, coalesce(d.cnd_name, a.value1) AS v
  FROM additional_info a LEFT JOIN dictionary d ON CAST(d.id AS VARCHAR) = a.value1 WHERE a.action_type = 'loan_state_remark_reason' AND a.deleted = 'N') WHERE v IS NOT NULL GROUP BY loan_id)"""
_REMARKS = """(SELECT loan_id, string_agg(v, '|' ORDER BY v) AS ops_remark FROM (SELECT DISTINCT loan_id, value1 AS v
  FROM additional_info WHERE action_type = 'loan_state_remark' AND deleted = 'N' AND value1 IS NOT NULL) GROUP BY loan_id)"""


@query("string_collect", uses="additional_info", sql=f"SELECT * FROM {_REMARKS} r")
def _(i):
    a = rows.active_only(i.additional_info).filter("action_type = 'loan_state_remark'")
    return rows.string_collect(a, "loan_id", "value1", "ops_remark")


@query("ops_remarks", uses="additional_info dictionary logins", sql=f"""
SELECT k.loan_id, ops_remark, ops_reason FROM (SELECT DISTINCT loan_id FROM additional_info WHERE deleted = 'N' AND action_type LIKE 'loan_state_remark%'
  AND created_by IN (SELECT CAST(uid AS VARCHAR) FROM logins)) k LEFT JOIN {_REMARKS} m ON m.loan_id = k.loan_id LEFT JOIN {_REASONS} s ON s.loan_id = k.loan_id""")
def _(i):
    return lead.ops_remarks(i.additional_info, i.logins, i.dictionary)


_T = "array_to_string(list_transform(string_split(lower(coalesce({c}, '')), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@query("slots_wide", uses="additional_info", sql="""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY n, p) AS k FROM (SELECT DISTINCT loan_id, """
       + _T.format(c="value1") + " AS n, " + _T.format(c="value2") + """ AS p FROM additional_info WHERE action_type = 'REFERENCE_DETAILS' AND deleted = 'N'))
SELECT loan_id, """ + ", ".join(f"max(CASE WHEN k = {k + 1} THEN n END) AS ref_name{f'_{k}' if k else ''}, max(CASE WHEN k = {k + 1} THEN p END) AS ref_contact{f'_{k}' if k else ''}"
                                for k in range(8)) + " FROM r GROUP BY loan_id")
def _(i):
    return lead.reference_contacts(i.additional_info)


@query("permanent_contacts", uses="additional_info", sql="""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY a, b, c) AS k FROM (SELECT DISTINCT loan_id, """
       + ", ".join(_T.format(c=f"value{j + 1}") + f" AS {x}" for j, x in enumerate("abc")) + """ FROM additional_info WHERE action_type = 'USER_PERMANENT_INFO'))
SELECT loan_id, max(CASE WHEN k = 1 THEN a END) AS permannent_address, max(CASE WHEN k = 1 THEN b END) AS permannent_contact, max(CASE WHEN k = 1 THEN c END) AS permannent_contact1,
  max(CASE WHEN k = 2 THEN a END) AS permannent_address_1, max(CASE WHEN k = 2 THEN b END) AS permannent_contact_1, max(CASE WHEN k = 2 THEN c END) AS permannent_contact1_1
FROM r GROUP BY loan_id""")
def _(i):
    return lead.permanent_contacts(i.additional_info)


@query("conditional_counts", uses="cheques", sql="SELECT loan_id, count(cheque_no) AS cheque_total, " + ", ".join(
    f"CAST(sum(CASE WHEN cheque_status IN ({', '.join(repr(x) for x in v)}) THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
    for n, v in fv.CHEQUE_COUNTERS.items()) + " FROM cheques WHERE deleted = 'N' GROUP BY loan_id")
def _(i):
    from lendmart.operators.leads import cheque_counts
    return cheque_counts(i.cheques)


@query("classify_codes", uses="raw_users", sql="SELECT highest_education, count(*) AS n, CASE " + " ".join(
    f"WHEN highest_education IN ({', '.join(repr(c) for c in codes)}) THEN '{label}'" for codes, label in fv.EDUCATION_LEVELS)
       + " ELSE 'Unknown' END AS level FROM raw_users GROUP BY highest_education")
def _(i):
    return (i.raw_users.groupBy("highest_education").agg(F.count("*").alias("n"))
            .withColumn("level", bands.classify("highest_education", fv.EDUCATION_LEVELS, "Unknown")))


def _asof_sql(view, score, offset, bands_sql):
    return f"""
WITH s AS (SELECT loanid AS loan_id, {bands_sql} AS score, CAST(DATE '1970-01-01' + CAST((created + {offset}) // 86400 AS INT) AS DATE) AS day, created, {score} AS raw
           FROM {view} WHERE {score} IS NOT NULL AND {score} <> '')
SELECT loan_id, score, day FROM (SELECT s.*, row_number() OVER (PARTITION BY loan_id ORDER BY day DESC, created DESC, raw DESC) AS rn
  FROM s LEFT JOIN milestone m ON m.loanid = s.loan_id WHERE m.first_disburse_date IS NULL OR s.day <= m.first_disburse_date) WHERE rn = 1"""


def _asof(i, scores, raw, offset, codes, mark, empty):
    disbursed = i.milestone.select(F.col("loanid").alias("loan_id"), "first_disburse_date")
    out = lead.score_frame(scores, disbursed, raw, "score_out", offset, codes, mark, empty)
    return out.select("loan_id", F.col("score_out").alias("score"), F.col("score_out_date").alias("day"))


@query("asof_score", uses="crif_scores milestone", sql=_asof_sql(
    "crif_scores", "score", 19800, "CASE WHEN score LIKE '%0-1%' THEN '0' ELSE score END"))
def _(i):
    return _asof(i, i.crif_scores, "score", 19800, None, "0", "0")


@query("asof_score_coded", uses="tu_scores milestone", sql=_asof_sql(
    "tu_scores", "cibil_score", 0, "CASE WHEN cibil_score LIKE '%0-1%' THEN '1' WHEN cibil_score IN ('000','001','002','003','004','005') THEN CAST(CAST(cibil_score AS INT) AS VARCHAR) ELSE cibil_score END"))
def _(i):
    return _asof(i, i.tu_scores, "cibil_score", 0, fv.SCORE_CODES, "1", None)


@query("recent_months_average", uses="inst", sql="""
SELECT loan_id, round(avg(a), 4) AS balance FROM (SELECT loan_id, m, a, row_number() OVER (PARTITION BY loan_id ORDER BY m DESC) AS rn
  FROM (SELECT loan_id, date_trunc('month', due) AS m, avg(CAST(amount AS DOUBLE)) AS a FROM inst GROUP BY ALL)) WHERE rn <= 3 GROUP BY loan_id""")
def _(i):
    out = rows.recent_months_average(i.inst.withColumn("amount", F.col("amount").cast("double")), "loan_id", "due", "amount", "balance")
    return out.withColumn("balance", F.round("balance", 4))


@query("exists_flag", uses="raw_loans bureau_ignore", sql="""
SELECT id, CASE WHEN id IN (SELECT loan_id FROM bureau_ignore WHERE deleted = 'N') THEN 1 ELSE 0 END AS ignore_flag FROM raw_loans""")
def _(i):
    return rows.exists_flag(i.raw_loans.select("id"), "id", rows.active_only(i.bureau_ignore), "loan_id", "ignore_flag")


@query("asof_score_many_events", uses="scores disbursals", sql="""
SELECT e.loanid, e.disbursed, s.raw_score AS score, s.day AS score_day
FROM (SELECT DISTINCT loanid, disbursed FROM disbursals) e
LEFT JOIN LATERAL (SELECT raw_score, day FROM scores s WHERE s.loanid = e.loanid AND s.day <= e.disbursed ORDER BY day DESC, id DESC LIMIT 1) s ON TRUE""")
def _(i):
    scores = i.scores.select("loanid", F.col("raw_score").alias("score"), F.col("day").alias("score_day"), "id")
    return rows.asof_events(scores, i.disbursals, "loanid", "score", "score_day", "disbursed", "id", bucket="week")
