"""Installments, balances, days past due, snapshots.

The SQL side says the same in the most direct way (windows over raw rows, a join of every
installment to every month); the Spark side uses grouped and month-grain plans.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import query
from lendmart.config import SiteConfig
from lendmart.functions import bands
from lendmart.functions.dates import cycle_cutoff, date_lit, fiscal_calendar
from lendmart.operators import installments as ins
from lendmart.operators import snapshots as snap
from lendmart.plans import portfolio
from lendmart.sources.catalog import Catalog, installments

AS_OF = views.AS_OF
D = f"DATE '{AS_OF}'"
M0, M1 = "DATE '1998-06-01'", "DATE '1998-06-30'"
P0, P1 = "DATE '1998-05-01'", "DATE '1998-05-31'"
SITE = SiteConfig(priority_lenders=((10, "FD"), (20, "INDMoney"), (30, "MLP")),
                  collection_lenders=((10, "FD"), (20, "INDMoney")), tracked_lender=10)
MEASURES = ins.MEASURES


def tag_sql(n=3, lender="lender"):
    names = ("FD", "INDMoney", "MLP")[:n]
    return "CASE " + " ".join(f"WHEN sum(CASE WHEN {lender} = {10 * (k + 1)} THEN 1 ELSE 0 END) > 0 THEN '{x}'"
                              for k, x in enumerate(names)) + " ELSE 'Non-FD' END"


def money(expr):
    return f"CAST({expr} AS DECIMAL(38,2))"


def sum_if(cond, measure, alias):
    return f"{money(f'sum(CASE WHEN {cond} THEN {measure} ELSE 0 END)')} AS {alias}"


@query("installments_source", uses="live_inst", sql="SELECT loan_id, lender, due, created, updated, state, amount, principal, interest FROM live_inst")
def _(i):
    return installments(Catalog(i.spark, frames={"installments": i.raw_installments})).drop("emi_month")


def idless(i):
    return installments(Catalog(i.spark, frames={"installments": i.raw_installments_idless}))


@query("installments_source_idless", uses="idless_inst", sql="SELECT loan_id, lender, due, created, updated, state, amount, principal, interest FROM idless_inst")
def _(i):
    return idless(i).drop("emi_month")


@query("portfolio_tag", uses="inst", sql=f"SELECT loan_id, {tag_sql()} AS portfolio_type FROM inst GROUP BY loan_id")
def _(i):
    return i.inst.groupBy("loan_id").agg(ins.portfolio_tag(SITE.priority_lenders).alias("portfolio_type"))


_CLS = "CASE WHEN state IN ('paid', 'closed') THEN 'paid' ELSE 'due' END"


@query("number_installments", uses="inst", sql=f"""
SELECT loan_id, lender, due, created, state, line, amount, CAST(date_trunc('month', due) AS DATE) AS emi_month,
  dense_rank() OVER (PARTITION BY loan_id ORDER BY date_trunc('month', due)) AS emi_no, dense_rank() OVER (PARTITION BY loan_id ORDER BY due) AS emi_no_act,
  dense_rank() OVER (PARTITION BY loan_id, {_CLS} ORDER BY date_trunc('month', due)) AS emistate_no,
  dense_rank() OVER (PARTITION BY loan_id, created ORDER BY date_trunc('month', due)) AS created_no,
  CASE WHEN state = 'due' THEN dense_rank() OVER (PARTITION BY loan_id, {_CLS} ORDER BY date_trunc('month', due)) ELSE 0 END AS emidue_no,
  CASE WHEN state <> 'due' THEN dense_rank() OVER (PARTITION BY loan_id, {_CLS} ORDER BY date_trunc('month', due)) ELSE 0 END AS emipaid_no
FROM inst""")
def _(i):
    return ins.number_installments(i.inst.drop("updated", "principal", "interest"))


@query("number_installments_idless", uses="idless_inst", sql=f"""
SELECT loan_id, due, created, state, amount, dense_rank() OVER (PARTITION BY loan_id ORDER BY date_trunc('month', due) NULLS LAST) AS emi_no,
  dense_rank() OVER (PARTITION BY loan_id ORDER BY due NULLS LAST) AS emi_no_act, dense_rank() OVER (PARTITION BY loan_id, {_CLS} ORDER BY date_trunc('month', due) NULLS LAST) AS emistate_no,
  dense_rank() OVER (PARTITION BY loan_id, created ORDER BY date_trunc('month', due) NULLS LAST) AS created_no FROM idless_inst""")
def _(i):
    return ins.number_installments(idless(i)).select("loan_id", "due", "created", "state", "amount", "emi_no", "emi_no_act", "emistate_no", "created_no")


@query("month_status", uses="inst", sql="""
SELECT loan_id, due, state, amount, CAST(date_trunc('month', due) AS DATE) AS emi_month,
  CASE WHEN sum(CASE WHEN state = 'due' THEN 1 ELSE 0 END) OVER (PARTITION BY loan_id, date_trunc('month', due)) > 0 THEN 'due' ELSE 'paid' END AS emi_status FROM inst""")
def _(i):
    return ins.month_status(i.inst.select("loan_id", "due", "state", "amount"))


@query("first_created", uses="inst", sql="""
SELECT loan_id, lender, created, amount, min(created) OVER (PARTITION BY loan_id, lender) AS prop_created_date,
  CASE WHEN min(created) OVER (PARTITION BY loan_id, lender) = created THEN 0 ELSE 1 END AS emi_foreclosure FROM inst""")
def _(i):
    return ins.first_created(i.inst.select("loan_id", "lender", "created", "amount"))


_SET = "state <> 'due'"
PERIODS = {
    "loan_total_{m}": "state <> 'closed'", "total_paid_{m}": "state = 'paid'",
    "total_paid_{m}_this_month": f"state = 'paid' AND updated BETWEEN {M0} AND {D}",
    "total_paid_{m}_previous_month": f"state = 'paid' AND updated BETWEEN {P0} AND {P1}",
    "total_due_{m}": "state = 'due'",
    "total_due_{m}_start_month": f"created < {M0} AND (state = 'due' OR ({_SET} AND updated >= {M0}))",
    "due_{m}_to_collect": f"state = 'due' AND due <= {M1}",
    "due_{m}_current_month_emi": f"state = 'due' AND due BETWEEN {M0} AND {M1}",
    "due_{m}_to_collect_month_start": f"created < {M0} AND due <= {M1} AND (state = 'due' OR updated BETWEEN {M0} AND {M1})",
    "due_{m}_to_collect_previous_month_start": f"created < {P0} AND due <= {P1} AND (state = 'due' OR updated BETWEEN {P0} AND {D})",
}


def period_sql():
    out = []
    for name, cond in PERIODS.items():
        for m in MEASURES:
            c = cond
            if name == "total_due_{m}_start_month" and m == "principal":
                c = f"state = 'due' OR (state = 'paid' AND updated >= {M0})"
            out.append(sum_if(c, m, name.format(m=m)))
    out.append(sum_if(f"created < {P0} AND (state = 'due' OR updated BETWEEN {P0} AND {M1})", "principal", "pos_previous_month"))
    return ", ".join(out)


@query("period_sums", uses="inst", sql=f"SELECT loan_id, {period_sql()} FROM inst GROUP BY loan_id")
def _(i):
    return ins.period_sums(i.inst, AS_OF)


@query("open_as_of", uses="inst", sql=f"""
SELECT loan_id, CAST(sum(CASE WHEN state = 'due' OR (state = 'paid' AND updated > {D}) THEN 1 ELSE 0 END) AS BIGINT) AS open_strict,
  CAST(sum(CASE WHEN state = 'due' OR (state = 'paid' AND updated >= {D}) THEN 1 ELSE 0 END) AS BIGINT) AS open_inclusive,
  CAST(sum(CASE WHEN state = 'due' OR updated > {D} THEN 1 ELSE 0 END) AS BIGINT) AS open_any FROM inst GROUP BY loan_id""")
def _(i):
    def n(c):
        return F.sum(F.when(c, 1).otherwise(0))
    return i.inst.groupBy("loan_id").agg(n(ins.open_as_of(AS_OF)).alias("open_strict"), n(ins.open_as_of(AS_OF, strict=False)).alias("open_inclusive"),
                                         n(ins.open_as_of(AS_OF, settled_states=None)).alias("open_any"))


@query("days_past_due", uses="inst", sql=f"""
SELECT loan_id, low AS due_emi_date, first_emi_date, CASE WHEN low <= {D} THEN datediff('day', low, {D}) END AS dpd FROM (
  SELECT loan_id, min(due) AS first_emi_date, min(CASE WHEN state = 'due' OR (state = 'paid' AND updated > {D}) THEN due END) AS low FROM inst GROUP BY loan_id)""")
def _(i):
    return ins.days_past_due(i.inst, AS_OF)


def bucket_sql(kind, dpd="dpd", first="first_emi_date", settled="settled", at=D):
    """CASE text of one label set, ranges written as BETWEEN."""
    ops = kind.startswith(("ops", "loan", "snapshot"))
    suffix = " DPD" if kind in ("loan", "snapshot") else ""
    second = " DPD" if kind == "snapshot" else ""
    if ops:
        cur, future, closed = "A1_Current", "A8_Future EMI", "A7_Closed"
        parts = [(f"{dpd} <= 0", cur), (f"{dpd} BETWEEN 1 AND 30", "A2_1-30" + second), (f"{dpd} BETWEEN 31 AND 60", "A3_31-60" + suffix),
                 (f"{dpd} BETWEEN 61 AND 90", "A4_61-90" + suffix), (f"{dpd} BETWEEN 91 AND 180", "A5_91-180" + suffix), (f"{dpd} > 180", "A6_180+" + suffix)]
    else:
        cur, future, closed = "A1_0-4", "A9_Future EMI", "A8_Closed"
        parts = [(f"{dpd} <= 4", cur), (f"{dpd} BETWEEN 5 AND 30", "A2_5-30"), (f"{dpd} BETWEEN 31 AND 60", "A3_31-60"), (f"{dpd} BETWEEN 61 AND 90", "A4_61-90"),
                 (f"{dpd} BETWEEN 91 AND 180", "A5_91-180"), (f"{dpd} BETWEEN 181 AND 360", "A6_181-360"), (f"{dpd} > 360", "A7_360+")]
    if "window" in kind:
        start, end = at
        head = [(f"{first} BETWEEN {start} AND {end}", "A0_1st EMI"), (f"{first} > {end}", future), (settled, closed)]
        seq, tail = head + parts, cur
    elif kind == "loan":
        seq, tail = parts + [(settled, closed), (f"{first} > {at}", future)], cur
    else:
        seq, tail = [(f"{first} > {at}", future)] + parts + [(settled, closed)], cur
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in seq) + f" ELSE '{tail}' END"


@query("bucket_dpd", uses="inst", sql=f"""
SELECT loan_id, dpd, {bucket_sql('ops')} AS ops, {bucket_sql('finance')} AS finance, {bucket_sql('loan')} AS loan, {bucket_sql('snapshot')} AS snap,
  {bucket_sql('ops_window', at=(M0, M1))} AS ops_window, {bucket_sql('finance_window', at=(P0, P1))} AS finance_window
FROM (SELECT loan_id, first_emi_date, settled, CASE WHEN low <= {D} THEN datediff('day', low, {D}) END AS dpd FROM (
  SELECT loan_id, min(due) AS first_emi_date, min(CASE WHEN state = 'due' OR (state = 'paid' AND updated > {D}) THEN due END) AS low,
         sum(CASE WHEN state = 'due' THEN principal ELSE 0 END) <= 0 AS settled FROM inst GROUP BY loan_id))""")
def _(i):
    settled = i.inst.groupBy("loan_id").agg((F.sum(F.when(F.col("state") == "due", F.col("principal")).otherwise(F.lit(0))) <= 0).alias("settled"))
    df = ins.days_past_due(i.inst, AS_OF).join(settled, "loan_id")
    m0, m1, p0, p1 = (date_lit(x[6:16]) for x in (M0, M1, P0, P1))
    b = lambda s, w=None: bands.bucket_dpd("dpd", s, "first_emi_date", F.col("settled"), AS_OF, w)
    return df.select("loan_id", "dpd", b("ops").alias("ops"), b("finance").alias("finance"), b("loan").alias("loan"), b("snapshot").alias("snap"),
                     b("ops_window", (m0, m1)).alias("ops_window"), b("finance_window", (p0, p1)).alias("finance_window"))


@query("disbursement_rollup", uses="payment_register", sql=f"""
SELECT loan_id, min(d) AS first_disburse_date, max(d) AS last_disburse_date, {money('sum(instrument_amount)')} AS disburse_amount
FROM (SELECT *, CAST(DATE '1970-01-01' + CAST((CAST(payment_instrument_date AS BIGINT) + 19800) // 86400 AS INT) AS DATE) AS d FROM payment_register
      WHERE deleted = 'N' AND payment_status IN ('Paid', 'Pending', 'pending') AND pay_user_id <> 8888888888) GROUP BY loan_id""")
def _(i):
    return ins.register_rollup(i.payment_register, SITE.ignored_payees)


@query("proposal_rollup", uses="collected", sql=f"""
SELECT loan_id, min(day) AS first_day, max(day) AS last_day, {money('sum(cp_amount)')} AS proposal_amount, {tag_sql()} AS portfolio_type FROM collected GROUP BY loan_id""")
def _(i):
    return ins.proposal_rollup(ins.collected_proposals(i.proposals, i.proposal_collections), SITE.priority_lenders, SITE.other_portfolio)


@query("last_installment_amount", uses="inst", sql=f"""
SELECT loan_id, emi FROM (SELECT loan_id, {money('sum(amount)')} AS emi, row_number() OVER (PARTITION BY loan_id ORDER BY date_trunc('month', due) DESC) AS rn
  FROM inst GROUP BY loan_id, date_trunc('month', due)) WHERE rn = 1""")
def _(i):
    return ins.last_installment_amount(i.inst)


@query("cycle_cutoff", sql=f"""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CASE WHEN day(o_orderdate) < 25 THEN CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE)
  ELSE CAST(last_day(CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE)) AS DATE) END AS cutoff FROM orders""")
def _(i):
    return i.orders.select(F.to_date("o_orderdate").alias("day")).distinct().withColumn("cutoff", cycle_cutoff(F.col("day")))


@query("fiscal_calendar", sql="""
SELECT d AS day, 'CY ' || year(d) AS cy, 'CY ' || year(d) || '-Q' || quarter(d) AS cy_qtr, fy, fy || '-Q' || CASE quarter(d) WHEN 1 THEN 4 ELSE quarter(d) - 1 END AS fy_qtr,
  CASE WHEN month(d) <= 3 THEN month(d) + 9 ELSE month(d) - 3 END AS fy_month
FROM (SELECT d, 'FY ' || (CASE WHEN month(d) <= 3 THEN year(d) - 1 ELSE year(d) END) || '-' || right(CAST(CASE WHEN month(d) <= 3 THEN year(d) ELSE year(d) + 1 END AS VARCHAR), 2) AS fy
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))""")
def _(i):
    days = i.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", *[c.alias(n) for n, c in fiscal_calendar("day").items()])


def position_sql(as_of, cutoff, source="inst"):
    d, c = f"DATE '{as_of}'", f"DATE '{cutoff}'"
    due = "FILTER (WHERE state = 'due')"
    parts = []
    for m in MEASURES:
        parts.append(f"coalesce({money(f'sum({m}) {due}')}, 0) AS current_total_due_{m}")
        parts.append(sum_if(f"state = 'due' AND due <= {d}", m, f"current_due_{m}"))
    for m in ("amount", "principal"):
        parts.append(sum_if(f"state = 'due' AND due <= {c}", m, f"pt_current_due{m}"))
    parts += [sum_if("state <> 'closed' AND amount >= 0", "amount", "amount_total"), sum_if("state <> 'closed' AND principal >= 0", "principal", "principal_total"),
              sum_if("state <> 'closed' AND interest > 0", "interest", "interest_total"), sum_if("state = 'paid' AND amount >= 0", "amount", "emi_total_paid"),
              sum_if("state = 'paid' AND principal >= 0", "principal", "principal_total_paid"), sum_if("state = 'paid' AND interest >= 0", "interest", "interest_total_paid")]
    nth = [f"sum(CASE WHEN no = {k} THEN amount ELSE 0 END)" for k in (1, 2, 3)]
    pick = f"least({nth[1]}, {nth[2]})"
    mdiff = "(year({b}) * 12 + month({b})) - (year({a}) * 12 + month({a})) + 1"
    return f"""(SELECT *, CASE WHEN emi_due_date <= {d} THEN datediff('day', emi_due_date, {d}) END AS dpd_current,
  coalesce({mdiff.format(a='emi_duedate_first', b='emi_duedate_last')}, 0) AS count_of_emi_due, {mdiff.format(a='pt_due_date_since', b='pt_last_due_date')} AS pt_count_of_emi_due
FROM (SELECT loan_id, {tag_sql()} AS portfolio_type, max(no) AS count_total_emi, coalesce(min(no) {due} - 1, max(no)) AS count_paid_emi,
  coalesce(max(no) - min(no) {due} + 1, 0) AS count_balance_emi, {money(nth[0])} AS first_emi_amount, {money(f'CASE WHEN {pick} > 0 THEN {pick} ELSE {nth[0]} END')} AS loan_emi_amount,
  {', '.join(parts)}, min(due) AS first_emi_date, max(due) AS last_emi_date, max(updated) FILTER (WHERE state = 'paid') AS last_paid_date,
  min(due) {due} AS emi_due_date, coalesce(max(no) {due} - min(no) {due} + 1, 0) AS count_of_emi_total_due,
  min(due) FILTER (WHERE state = 'due' AND due <= {d}) AS emi_duedate_first, max(due) FILTER (WHERE state = 'due' AND due <= {d}) AS emi_duedate_last,
  min(due) FILTER (WHERE state = 'due' AND due <= {c}) AS pt_due_date_since, max(due) FILTER (WHERE state = 'due' AND due <= {c}) AS pt_last_due_date,
  max(CASE WHEN no > 1 THEN DATE '1900-01-01' WHEN state = 'due' THEN DATE '1900-01-02' WHEN state = 'paid' THEN updated ELSE DATE '1970-01-01' END) AS first_emi_paid_date
FROM (SELECT *, dense_rank() OVER (PARTITION BY loan_id ORDER BY date_trunc('month', due)) AS no FROM {source}) GROUP BY loan_id))"""


@query("loan_position", uses="inst", sql=f"SELECT * FROM {position_sql(AS_OF, '1998-06-30')} p")
def _(i):
    return portfolio.loan_position(i.inst, AS_OF, SITE)


@query("loan_position_idless", uses="idless_inst", sql=f"SELECT * FROM {position_sql(AS_OF, '1998-06-30', 'idless_inst')} p")
def _(i):
    return portfolio.loan_position(idless(i), AS_OF, SITE)


@query("loan_position_late_cycle", uses="inst", sql=f"SELECT * FROM {position_sql(views.AS_OF_LATE, '1998-07-31')} p")
def _(i):
    return portfolio.loan_position(i.inst, views.AS_OF_LATE, SITE)


@query("due_rollup", uses="inst", sql=f"""SELECT loan_id, {', '.join(money(f'sum({m})') + f' AS current_total_due_{m}' for m in MEASURES)},
  {', '.join(sum_if(f'due <= {D}', m, f'current_due_{m}') for m in MEASURES)}, {', '.join(sum_if('lender = 10', m, f'current_fddue{m}') for m in MEASURES)},
  {', '.join(sum_if(f'due <= {M1}', m, f'pt_current_due{m}') for m in ('amount', 'principal'))}, min(due) AS emi_due_date,
  min(CASE WHEN due <= {D} THEN due END) AS emi_duedate_first, max(CASE WHEN due <= {D} THEN due END) AS emi_duedate_last,
  min(CASE WHEN due <= {M1} THEN due END) AS pt_due_date_since, max(CASE WHEN due <= {M1} THEN due END) AS pt_last_due_date FROM inst WHERE state = 'due' GROUP BY loan_id""")
def _(i):
    return ins.due_rollup(i.inst, AS_OF, SITE.tracked_lender, cycle_cutoff(AS_OF))


@query("representative_installment", uses="inst", sql=f"""
SELECT loan_id, {money('CASE WHEN p > 0 THEN p ELSE a1 END')} AS emi FROM (SELECT *, CASE WHEN a2 <= a3 THEN a2 ELSE a3 END AS p FROM (
  SELECT loan_id, {', '.join(f'sum(CASE WHEN no = {k} THEN amount ELSE 0 END) AS a{k}' for k in (1, 2, 3))}
  FROM (SELECT *, dense_rank() OVER (PARTITION BY loan_id ORDER BY date_trunc('month', due)) AS no FROM inst) GROUP BY loan_id))""")
def _(i):
    m = ins.month_numbers(ins.by_month(i.inst, {}, {"a": F.sum("amount")}))
    n = {k: F.sum(F.when(F.col("emi_no") == k, F.col("a")).otherwise(F.lit(0))) for k in (1, 2, 3)}
    return m.groupBy("loan_id").agg(ins.representative_installment(n[2], n[3], n[1]).alias("emi"))


@query("loan_totals", uses="inst", sql=f"""SELECT loan_id, {sum_if("state <> 'closed' AND amount >= 0", 'amount', 'amount_total')},
  {sum_if("state <> 'closed' AND principal >= 0", 'principal', 'principal_total')}, {sum_if("state <> 'closed' AND interest > 0", 'interest', 'interest_total')},
  {sum_if("state = 'paid' AND amount >= 0", 'amount', 'emi_total_paid')}, {sum_if("state = 'paid' AND principal >= 0", 'principal', 'principal_total_paid')},
  {sum_if("state = 'paid' AND interest >= 0", 'interest', 'interest_total_paid')}, min(due) AS first_emi_date, max(due) AS last_emi_date,
  max(CASE WHEN state = 'paid' THEN updated END) AS last_paid_date FROM inst GROUP BY loan_id""")
def _(i):
    return ins.loan_totals(i.inst)


FEES_SQL = """(SELECT loan_id, round(sum(CASE WHEN txn_type = 1358 THEN txn_amount ELSE 0 END), 0) AS registration_fees,
  round(sum(CASE WHEN txn_type = 90133286 THEN txn_amount ELSE 0 END), 0) AS processing_fees FROM transactions WHERE deleted = 'N' AND txn_state = 200 GROUP BY loan_id)"""


@query("fee_totals", uses="transactions", sql=f"SELECT * FROM {FEES_SQL} f")
def _(i):
    return ins.fee_totals(i.transactions)


SUMMARY_SQL = f"""(SELECT loan_id, {tag_sql()} AS portfolio_type, {', '.join(sum_if("state <> 'closed'", m, f'loan_total_{m}') for m in MEASURES)},
  count(DISTINCT last_day(due)) AS total_emi_count, min(due) AS first_emi_date, max(due) AS last_emi_date, min(created) AS min_emi_created FROM {{src}} GROUP BY loan_id)"""


@query("loan_summary", uses="inst", sql=f"SELECT * FROM {SUMMARY_SQL.format(src='inst')} s")
def _(i):
    return snap.loan_summary(i.inst, SITE.priority_lenders, SITE.other_portfolio)


SPINE_SQL = f"""(SELECT s.*, m.status_month FROM {{loans}} s JOIN (SELECT CAST(last_day(CAST(x AS DATE)) AS DATE) AS status_month
  FROM generate_series(DATE '1990-01-01', {D}, INTERVAL 1 MONTH) t(x)) m ON m.status_month >= s.disburse_date)"""


@query("loan_month_spine", uses="loans", sql="SELECT loan_id, status_month FROM " + SPINE_SQL.format(
    loans="(SELECT loan_id, created AS disburse_date FROM loans)") + " x")
def _(i):
    return snap.loan_month_spine(i.loans.select("loan_id", "created"), AS_OF, start="created").select("loan_id", "status_month")


def monthly_sql(spine, src):
    open_m = "(state = 'due' OR (state = 'paid' AND updated > status_month))"
    late = "last_day(due) = status_month AND due <= {d} AND (state = 'due' OR (state = 'paid' AND updated - due > {n}))"
    cols = [sum_if("state = 'paid' AND updated <= status_month", m, f"total_paid_{m}") for m in MEASURES]
    cols += [sum_if("state = 'paid' AND updated <= status_month AND updated >= date_trunc('month', status_month)", m, f"total_paid_{m}_this_month") for m in MEASURES]
    cols += [sum_if(open_m, m, f"total_due_{m}") for m in MEASURES]
    cols += [sum_if(f"{open_m} AND last_day(due) <= status_month", m, f"due_{m}_to_collect") for m in MEASURES]
    return f"""(SELECT loan_id, status_month, CAST(sum(CASE WHEN state = 'due' OR (state = 'paid' AND updated >= status_month) THEN 1 ELSE 0 END) AS BIGINT) AS active_count,
  count(DISTINCT CASE WHEN state <> 'due' AND updated <= status_month THEN last_day(due) END) AS paid_emi_count, {', '.join(cols)},
  max(CASE WHEN state = 'paid' AND updated <= status_month THEN updated END) AS last_paid_date,
  min(CASE WHEN state = 'due' OR updated > status_month THEN due END) AS due_emi_date,
  min(CASE WHEN {open_m} AND last_day(due) <= status_month THEN due END) AS min_overdue_emi_date,
  CAST(sum(CASE WHEN {late.format(d=D, n=4)} THEN 1 ELSE 0 END) AS BIGINT) AS bounce_relax_count, CAST(sum(CASE WHEN {late.format(d=D, n=0)} THEN 1 ELSE 0 END) AS BIGINT) AS bounce_act_count
FROM (SELECT k.status_month, e.* FROM {spine} k JOIN {src} e ON e.loan_id = k.loan_id) GROUP BY loan_id, status_month)"""


_KEYS = "(SELECT loan_id, status_month FROM " + SPINE_SQL.format(loans="(SELECT loan_id, min(created) AS disburse_date FROM inst GROUP BY loan_id)") + " z)"


@query("monthly_asof_agg", uses="inst", sql=f"SELECT * FROM {monthly_sql(_KEYS, 'inst')} a")
def _(i):
    loans = i.inst.groupBy("loan_id").agg(F.min("created").alias("disburse_date"))
    return snap.monthly_asof_agg(snap.loan_month_spine(loans, AS_OF), i.inst, AS_OF)


@query("monthly_asof_agg_idless", uses="idless_inst", sql=f"SELECT * FROM {monthly_sql(_KEYS.replace('inst', 'idless_inst'), 'idless_inst')} a")
def _(i):
    inst = idless(i)
    loans = inst.groupBy("loan_id").agg(F.min("created").alias("disburse_date"))
    return snap.monthly_asof_agg(snap.loan_month_spine(loans, AS_OF), inst, AS_OF)


@query("current_month_agg", uses="inst", sql=f"SELECT * FROM {monthly_sql(_KEYS, 'inst')} a WHERE status_month = {M1}")
def _(i):
    loans = i.inst.groupBy("loan_id").agg(F.min("created").alias("disburse_date"))
    return snap.current_month_agg(snap.loan_month_spine(loans, AS_OF, only_current=True), i.inst, AS_OF)


@query("bounce_flags", uses="inst", sql=f"""
SELECT loan_id, CAST(last_day(due) AS DATE) AS status_month, CAST(sum(CASE WHEN due <= {D} AND (state = 'due' OR (state = 'paid' AND updated - due > 4)) THEN 1 ELSE 0 END) AS BIGINT) AS bounce_relax_count,
  CAST(sum(CASE WHEN due <= {D} AND (state = 'due' OR (state = 'paid' AND updated - due > 0)) THEN 1 ELSE 0 END) AS BIGINT) AS bounce_act_count FROM inst GROUP BY ALL""")
def _(i):
    return snap.bounce_flags(i.inst, AS_OF)


@query("months_on_book", uses="loans", sql="""
SELECT loan_id, status_month, datediff('month', f, status_month) + 1 AS mob_emi, datediff('month', disburse_date, status_month) AS mob
FROM (SELECT *, disburse_date + 40 AS f FROM """ + SPINE_SQL.format(loans="(SELECT loan_id, created AS disburse_date FROM loans)") + " x)")
def _(i):
    s = snap.loan_month_spine(i.loans.select("loan_id", F.col("created").alias("disburse_date")), AS_OF)
    s = s.withColumn("f", F.date_add("disburse_date", 40))
    return s.select("loan_id", "status_month", *[c.alias(n) for n, c in snap.months_on_book("f", "disburse_date", "status_month").items()])


@query("missed_payment_flags", uses="inst", sql=f"""
SELECT a.loan_id, a.status_month, CASE WHEN (last_day(l.last_due) < status_month AND active_count > 0) OR bounce_relax_count > 0 THEN 1 ELSE 0 END AS missed_payment_relaxed,
  CASE WHEN (last_day(l.last_due) < status_month AND active_count > 0) OR bounce_act_count > 0 THEN 1 ELSE 0 END AS missed_payment_actual
FROM {monthly_sql(_KEYS, 'inst')} a JOIN (SELECT loan_id, max(due) AS last_due FROM inst GROUP BY loan_id) l ON l.loan_id = a.loan_id""")
def _(i):
    loans = i.inst.groupBy("loan_id").agg(F.min("created").alias("disburse_date"), F.max("due").alias("last_due"))
    a = snap.monthly_asof_agg(snap.loan_month_spine(loans, AS_OF), i.inst, AS_OF).join(loans, "loan_id")
    flags = snap.missed_payment_flags("last_due", "status_month", F.col("active_count") > 0, F.col("bounce_relax_count") > 0, F.col("bounce_act_count") > 0)
    return a.select("loan_id", "status_month", *[c.alias(n) for n, c in flags.items()])
