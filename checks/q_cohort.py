"""Cohort bands, repeat borrowers and related flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import query
from lendmart import fixed_values as fv
from lendmart.functions import bands
from lendmart.functions.dates import age_years
from lendmart.functions.text import extract_decimal
from lendmart.operators import cohorts

D = f"DATE '{views.AS_OF}'"


def between_sql(value, edges, beyond, step=1, missing=None):
    """CASE text from half-open ranges: [low, edge)."""
    out, low = [], None
    if missing:
        out.append(f"WHEN {value} IS NULL THEN '{missing}'")
    for edge, label in edges:
        cond = f"{value} < {edge}" if low is None else f"{value} >= {low} AND {value} < {edge}"
        out.append(f"WHEN {cond} THEN '{label}'")
        low = edge
    return "CASE " + " ".join(out) + (f" ELSE '{beyond}' END" if beyond else " END")


def upto(edges, step="0.0001"):
    """Inclusive edges as exclusive ones, for values with at most three decimals."""
    return [(f"{e} + {step}", label) for e, label in edges]


LOANS_SQL = """(SELECT l.loan_id, l.borrower, l.created AS disburse_date, l.state AS sub_category, l.product AS category, 'ch' || CAST(l.loan_id % 3 AS VARCHAR) AS channel,
  l.created + 360 AS last_emi_date, CASE WHEN l.loan_id % 3 = 0 THEN NULL ELSE l.created + CAST(l.loan_id % 500 AS INT) END AS loan_close_date FROM loans l)"""


def loans(i):
    return i.loans.select(
        "loan_id", "borrower", F.col("created").alias("disburse_date"), F.col("state").alias("sub_category"), F.col("product").alias("category"),
        F.concat(F.lit("ch"), (F.col("loan_id") % 3).cast("string")).alias("channel"), F.date_add("created", 360).alias("last_emi_date"),
        F.when(F.col("loan_id") % 3 != 0, F.date_add("created", (F.col("loan_id") % 500).cast("int"))).alias("loan_close_date"))


_W = "OVER (PARTITION BY borrower ORDER BY disburse_date, loan_id)"


@query("repeat_borrower", uses="loans", sql=f"""
SELECT *, CASE WHEN pan_count > 1 THEN 1 ELSE 0 END AS top_up, CASE WHEN pan_count = 1 THEN 0 WHEN old_loan_close_date IS NULL THEN 30
  ELSE datediff('day', disburse_date, old_loan_close_date) END AS top_date_diff
FROM (SELECT l.*, row_number() {_W} AS pan_count, lag(sub_category) {_W} AS old_sub_category, lag(category) {_W} AS old_category, lag(channel) {_W} AS old_channel,
  lag(last_emi_date) {_W} AS old_loan_last_emi_date, lag(loan_close_date) {_W} AS old_loan_close_date FROM {LOANS_SQL} l)""")
def _(i):
    return cohorts.repeat_borrower(loans(i), "borrower", "disburse_date")


@query("numbered_with_previous_same_day", uses="inst", sql="""
SELECT lender, due, loan_id, amount, row_number() OVER (PARTITION BY lender ORDER BY due, loan_id, amount) AS no,
  lag(amount) OVER (PARTITION BY lender ORDER BY due, loan_id, amount) AS before FROM (SELECT DISTINCT lender, due, loan_id, amount FROM inst)""")
def _(i):
    from lendmart.operators.rows import numbered_with_previous
    df = i.inst.select("lender", "due", "loan_id", "amount").distinct().withColumn("tie", F.struct("loan_id", "amount"))
    return numbered_with_previous(df, "lender", "due", "tie", "no", {"before": "amount"}).drop("tie")


@query("band", uses="leads", sql=f"""
SELECT loan_id, {between_sql('tenure_monthsno', [(e + 1, l) for e, l in fv.TENURE_LE], None)} AS tenure_group,
  {between_sql('rate_max_approved', fv.ROI_LT + [(e + 0.001, l) for e, l in fv.ROI_LE], fv.ROI_ELSE)} AS roi_group,
  {between_sql('age_loanregister', fv.AGE_LT, fv.AGE_ELSE)} AS age_group, {between_sql('age_loanregister', upto(fv.GENERATION_LE), None, missing='Unknown')} AS generations,
  {between_sql('loan_amount_expected * 70', fv.AMOUNT_LT, fv.AMOUNT_ELSE)} AS amount_group,
  {between_sql("TRY_CAST(nullif(crif_score, '') AS INT)", upto(fv.SCORE_LE), fv.SCORE_ELSE, missing=fv.SCORE_NULL)} AS score_group,
  {between_sql("datediff('day', loan_registered_date, first_disburse_date)", upto(fv.TURNAROUND_LE), fv.TURNAROUND_ELSE, missing='NA')} AS tat_grp,
  {between_sql("datediff('month', comp_startdate, loan_registered_date)", upto(fv.VINTAGE_LE), fv.VINTAGE_ELSE, missing='NA')} AS vintage_grp FROM leads""")
def _(i):
    from lendmart.functions.dates import days_between, months_between
    return i.leads.select(
        "loan_id", bands.tenure_band("tenure_monthsno").alias("tenure_group"), bands.roi_band("rate_max_approved").alias("roi_group"),
        bands.age_band("age_loanregister").alias("age_group"), bands.generation("age_loanregister").alias("generations"),
        bands.amount_band(F.col("loan_amount_expected") * 70).alias("amount_group"),
        bands.score_band(F.col("crif_score").try_cast("int")).alias("score_group"),
        bands.turnaround_band(days_between("loan_registered_date", "first_disburse_date")).alias("tat_grp"),
        bands.vintage_band(months_between("comp_startdate", "loan_registered_date")).alias("vintage_grp"))


def employment_sql(value, raw, sal, sal_else, own, own_else):
    def one(edges, beyond, na):
        return f"CASE WHEN {raw} IS NULL OR {raw} = '' THEN '{na}' ELSE {between_sql(value, edges, beyond)} END"
    return f"CASE WHEN employement_type = 'Salaried Employee' THEN {one(sal, sal_else, 'SA_NA')} ELSE {one(own, own_else, 'SE_NA')} END"


INCOME = "TRY_CAST(nullif(regexp_extract(income, '[0-9]+.[0-9]+'), '') AS DECIMAL(10,2))"


@query("employment_bands", uses="leads", sql=f"""
SELECT loan_id, {employment_sql(INCOME, 'income', fv.INCOME_SALARIED_LT, fv.INCOME_SALARIED_ELSE, fv.INCOME_SELF_LT, fv.INCOME_SELF_ELSE)} AS income_group,
  {employment_sql("TRY_CAST(foir_before AS DECIMAL(10,3))", 'foir_before', fv.FOIR_BEFORE_SALARIED_LT, fv.FOIR_BEFORE_SALARIED_ELSE, fv.FOIR_BEFORE_SELF_LT, fv.FOIR_BEFORE_SELF_ELSE)} AS foir_before_group,
  {employment_sql("TRY_CAST(foir_after AS DECIMAL(10,3))", 'foir_after', fv.FOIR_AFTER_SALARIED_LT, fv.FOIR_AFTER_SALARIED_ELSE, fv.FOIR_AFTER_SELF_LT, fv.FOIR_AFTER_SELF_ELSE)} AS foir_after_group FROM leads""")
def _(i):
    e = "employement_type"
    return i.leads.select(
        "loan_id", bands.income_band(e, extract_decimal("income"), "income").alias("income_group"),
        bands.obligation_before_band(e, F.col("foir_before").try_cast("decimal(10,3)"), "foir_before").alias("foir_before_group"),
        bands.obligation_after_band(e, F.col("foir_after").try_cast("decimal(10,3)"), "foir_after").alias("foir_after_group"))


@query("risk_bucket", uses="raw_loans dictionary", sql=f"""
SELECT l.id, {between_sql('rate', [(12, '1.Premium')] + [(e + 0.001, l) for e, l in fv.RISK_RATE_LE], 'Unrated')} AS risk_bucket
FROM (SELECT l.id, CAST(trim(replace(d.cnd_name, '%', '')) AS DECIMAL(10,2)) AS rate FROM raw_loans l
      LEFT JOIN (SELECT * FROM dictionary WHERE deleted = 'N' AND cnd_group = 'INTREST_RATE') d ON d.id = l.max_irate_approved) l""")
def _(i):
    from lendmart.functions.text import percent_rate
    from lendmart.operators.rows import active_only, decode
    out = decode(i.raw_loans.select("id", "max_irate_approved"), "max_irate_approved", active_only(i.dictionary), "INTREST_RATE", "label")
    return out.select("id", bands.risk_bucket(percent_rate("label")).alias("risk_bucket"))


@query("age_generation", uses="leads", sql=f"""
SELECT loan_id, datediff('day', born, loan_registered_date) // 365 AS age, CAST(round(datediff('day', born, loan_registered_date) / 365.0, 1) AS DOUBLE) AS age_fractional,
  {between_sql("(datediff('day', born, loan_registered_date) // 365)", upto(fv.GENERATION_LE), None, missing='Unknown')} AS generations
FROM (SELECT *, user_dob - CAST(loan_id % 9000 AS INT) AS born FROM leads)""")
def _(i):
    df = i.leads.withColumn("born", F.date_sub("user_dob", (F.col("loan_id") % 9000).cast("int")))
    age = age_years("born", "loan_registered_date")
    return df.select("loan_id", age.alias("age"), age_years("born", "loan_registered_date", fractional=True).alias("age_fractional"),
                     bands.generation(age).alias("generations"))


_BUCKET = "CASE due_m % 7 " + " ".join(f"WHEN {k} THEN '{b}'" for k, b in enumerate(["A1_Current"] + fv.DELINQUENCY_LADDER)) + " ELSE 'A7_Closed' END"


@query("delinquency_flags", uses="inst", sql=f"""
SELECT loan_id, due, amount, """ + ", ".join(
    f"CASE WHEN b IN ({', '.join(repr(x) for x in fv.DELINQUENCY_LADDER[k:])}) THEN 1 ELSE 0 END AS {n}_count, "
    f"CASE WHEN b IN ({', '.join(repr(x) for x in fv.DELINQUENCY_LADDER[k:])}) THEN amount ELSE 0 END AS {n}" for n, k in fv.DELINQUENCY_STARTS.items())
       + f" FROM (SELECT *, {_BUCKET} AS b FROM (SELECT *, month(due) AS due_m FROM inst))")
def _(i):
    m = F.month("due") % 7
    b = bands.classify(m, [([k], x) for k, x in enumerate(["A1_Current"] + fv.DELINQUENCY_LADDER)], "A7_Closed")
    return i.inst.withColumn("b", b).select("loan_id", "due", "amount", *[c.alias(n) for n, c in bands.delinquency_flags("b", "amount").items()])


@query("non_starter", uses="inst", sql=f"""
SELECT loan_id, status_month, CASE WHEN pres THEN total ELSE 0 END AS la_1stemipresented, CASE WHEN pres AND total = open THEN 'Yes' ELSE 'No' END AS non_starter_flag,
  CASE WHEN pres AND total = open THEN 1 ELSE 0 END AS non_starter, CASE WHEN pres AND total = open THEN open ELSE 0 END AS non_starter_pos
FROM (SELECT loan_id, CAST(last_day(first) AS DATE) AS status_month, total, open, first <= last_day(first) - 4 AS pres FROM (
  SELECT loan_id, min(due) AS first, sum(principal) AS total, sum(CASE WHEN state = 'paid' AND updated <= last_day(due) THEN 0 ELSE principal END) AS open FROM inst GROUP BY loan_id))""")
def _(i):
    paid = (F.col("state") == "paid") & (F.col("updated") <= F.last_day("due"))
    df = i.inst.groupBy("loan_id").agg(F.min("due").alias("first"), F.sum("principal").alias("total"),
                                       F.sum(F.when(paid, F.lit(0)).otherwise(F.col("principal"))).alias("open"))
    df = df.withColumn("status_month", F.last_day("first"))
    return df.select("loan_id", "status_month", *[c.alias(n) for n, c in cohorts.non_starter("total", "open", "first", "status_month").items()])


@query("co_lender_score", uses="leads", sql="""
SELECT l.loan_id, CASE WHEN l.source = 'IMB' AND l.parent_uid <> 0 THEN TRY_CAST(nullif(p.crif_score, '') AS INT) ELSE TRY_CAST(nullif(l.crif_score, '') AS INT) END AS crif_score_original
FROM leads l LEFT JOIN (SELECT * FROM (SELECT user_id, crif_score, row_number() OVER (PARTITION BY user_id ORDER BY loan_id DESC) AS rn FROM leads WHERE loan_id NOT IN (7, 8)) WHERE rn = 1) p
ON p.user_id = l.parent_uid""")
def _(i):
    return cohorts.co_lender_score(i.leads, "IMB", [7, 8]).select("loan_id", "crif_score_original")


@query("mandate_presented", uses="leads mandate_ledger", sql=f"""
SELECT l.loan_id, CASE WHEN EXISTS (SELECT 1 FROM mandate_ledger m WHERE m.loan_id = l.loan_id AND m.unique_reference_no = l.ref AND m.deleted = 'N' AND m.ledger_type <> 'PENALTY'
  AND CAST(DATE '1970-01-01' + CAST((CAST(m.created AS BIGINT) + 19800) // 86400 AS INT) AS DATE) <= DATE '1998-06-01') THEN 'NACH' ELSE 'Others' END AS payment_presentation_method
FROM (SELECT o_custkey AS loan_id, 'REF' || lpad(CAST(max(o_orderkey) AS VARCHAR), 10, '0') AS ref FROM orders GROUP BY o_custkey) l""")
def _(i):
    refs = i.orders.groupBy(F.col("o_custkey").alias("loan_id")).agg(F.max("o_orderkey").alias("k"))
    refs = refs.select("loan_id", F.concat(F.lit("REF"), F.lpad(F.col("k").cast("string"), 10, "0")).alias("mandate_id"))
    return cohorts.mandate_presented(refs, cohorts.presented_mandates(i.mandate_ledger, views.AS_OF)).drop("mandate_id")
