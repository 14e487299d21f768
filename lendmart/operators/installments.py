"""Installments: numbering, balances, days past due, roll-ups.

Canonical columns: ``loan_id, lender, due, created, updated, state, amount, principal,
interest`` where ``due/created/updated`` are local days (see ``sources.installments``), and
optionally ``emi_month``, the first day of the due month, by which rows may be partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions.dates import col, date_lit, days_between, epoch_to_local_date, month_start
from lendmart.operators.bitmaps import bitmap_ranks, day_number, month_number
from lendmart.operators.rows import attach_group_values

MEASURES = ("amount", "principal", "interest")
MONEY, TOTAL = "decimal(28,2)", "decimal(38,2)"


def in_minor_units(df: DataFrame, measures=MEASURES) -> DataFrame:
    """Money columns as whole hundredths in a long: sums over raw rows stay primitive.

    Money is DECIMAL(18,2), so nothing is lost; a sum that leaves the long range fails
    the job under ANSI mode instead of wrapping.
    """
    return df.withColumns({m: (F.col(m) * 100).cast("long") for m in measures})


def money(c) -> Column:
    """Hundredths back to money."""
    return (col(c).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def in_money(df: DataFrame, names) -> DataFrame:
    """Sums of an account, added up as hundredths, as money; elsewhere ``money`` would be worked out for every month."""
    return df.withColumns({n: money(n).cast(TOTAL) for n in names})


def portfolio_tag(priority, lender: str = "lender", default: str = "Non-FD") -> Column:
    """Aggregate: label of the first priority lender present in the group."""
    out = None
    for uid, label in priority:
        present = F.max(F.when(F.col(lender) == uid, 1).otherwise(0)) > 0
        out = F.when(present, label) if out is None else out.when(present, label)
    return out.otherwise(default)


def is_paid() -> Column:
    """Paid or closed, as opposed to due."""
    return F.col("state").isin("paid", "closed")


def number_installments(df: DataFrame) -> DataFrame:
    """Running numbers of an installment: by month, by day, within paid / due, within creation day.

    A missing due day comes last; rows without a loan have no numbers.
    """
    out = df.withColumn("emi_month", month_start("due"))
    month, paid = month_number("due"), F.when(is_paid(), 1).otherwise(0).cast("long")
    out = bitmap_ranks(out, "loan_id", {
        "emi_no": (None, month), "emi_no_act": (None, day_number("due")), "emistate_no": (paid, month),
        "created_no": (day_number("created"), month)})
    return (out.withColumn("emidue_no", F.when(F.col("state") == "due", F.col("emistate_no")).otherwise(0))
               .withColumn("emipaid_no", F.when(is_paid(), F.col("emistate_no")).otherwise(0)))


def month_status(df: DataFrame) -> DataFrame:
    """A month of an account is due when any of its rows is due."""
    out = df.withColumn("emi_month", month_start("due"))
    out = attach_group_values(out, ["loan_id", "emi_month"], __due=F.max(F.when(F.col("state") == "due", 1).otherwise(0)))
    return out.withColumn("emi_status", F.when(F.col("__due") > 0, "due").otherwise("paid")).drop("__due")


def first_created(df: DataFrame) -> DataFrame:
    """First creation day per (loan, lender); rows created later stem from a foreclosure."""
    out = attach_group_values(df, ["loan_id", "lender"], prop_created_date=F.min("created"))
    return out.withColumn("emi_foreclosure", F.when(F.col("prop_created_date") == F.col("created"), 0).otherwise(1))


def open_as_of(day, strict: bool = True, settled_states=("paid",)) -> Column:
    """Still open at the end of ``day``: due, or settled later (``strict=False``: or on it)."""
    d = date_lit(day)
    later = F.col("updated") > d if strict else F.col("updated") >= d
    settled = F.col("state") != "due" if settled_states is None else F.col("state").isin(list(settled_states))
    return (F.col("state") == "due") | (settled & later)


def days_past_due(df: DataFrame, day, key: str = "loan_id") -> DataFrame:
    """Days from the oldest open installment to ``day``; NULL when none is open by then."""
    d = date_lit(day)
    oldest = F.min(F.when(open_as_of(d), F.col("due")))
    return (df.groupBy(key).agg(oldest.alias("due_emi_date"), F.min("due").alias("first_emi_date"))
              .withColumn("dpd", F.when(F.col("due_emi_date") <= d, days_between("due_emi_date", d))))


def sums(prefix: str, cond: Column | None, measures=MEASURES, suffix: str = "") -> dict[str, Column]:
    """One conditional sum per measure: ``{prefix}{measure}{suffix}``."""
    out = {}
    for m in measures:
        v = F.col(m) if cond is None else F.when(cond, F.col(m)).otherwise(F.lit(0))
        out[f"{prefix}{m}{suffix}"] = F.sum(v)
    return out


def period_conditions(as_of) -> dict[str, tuple[str, Column, tuple]]:
    """Row conditions of the collection sums: name -> (prefix, condition, measures, suffix)."""
    d = date_lit(as_of)
    m0, m1 = F.trunc(d, "month"), F.last_day(d)
    p0 = F.add_months(m0, -1)
    p1 = F.date_sub(m0, 1)
    st, cr, up, due = F.col("state"), F.col("created"), F.col("updated"), F.col("due")
    month = month_start("due")
    is_due, settled, is_paid_row = st == "due", st != "due", st == "paid"
    three = MEASURES
    return {
        "total": ("loan_total_", st != "closed", three, ""),
        "paid": ("total_paid_", is_paid_row, three, ""),
        "paid_this": ("total_paid_", is_paid_row & up.between(m0, d), three, "_this_month"),
        "paid_prev": ("total_paid_", is_paid_row & up.between(p0, p1), three, "_previous_month"),
        "due": ("total_due_", is_due, three, ""),
        "due_start": ("total_due_", (cr < m0) & (is_due | (settled & (up >= m0))), ("amount", "interest"), "_start_month"),
        # The principal ignores the creation day and closed rows.
        "due_start_principal": ("total_due_", is_due | (is_paid_row & (up >= m0)), ("principal",), "_start_month"),
        "collect": ("due_", is_due & (month <= m1), three, "_to_collect"),
        "current": ("due_", is_due & (month == m0), three, "_current_month_emi"),
        "collect_start": ("due_", (cr < m0) & (month <= m1) & (is_due | (settled & up.between(m0, m1))), three,
                          "_to_collect_month_start"),
        "collect_prev": ("due_", (cr < p0) & (month <= p1) & (is_due | (settled & up.between(p0, d))), three,
                         "_to_collect_previous_month_start"),
    }


def period_aggregates(as_of) -> dict[str, Column]:
    out = {}
    for prefix, cond, measures, suffix in period_conditions(as_of).values():
        out.update(sums(prefix, cond, measures, suffix))
    d = date_lit(as_of)
    m0, m1 = F.trunc(d, "month"), F.last_day(d)
    p0 = F.add_months(m0, -1)
    out["pos_previous_month"] = F.sum(F.when(
        (F.col("created") < p0) & ((F.col("state") == "due") | ((F.col("state") != "due") & F.col("updated").between(p0, m1))),
        F.col("principal")).otherwise(F.lit(0)))
    return out


def period_sums(df: DataFrame, as_of, key: str = "loan_id") -> DataFrame:
    """Paid, due and to-collect sums of this month, last month and the month start."""
    aggs = period_aggregates(as_of)
    return in_money(by_month(df, {}, aggs, minor=True).groupBy(key).agg(*[F.sum(n).alias(n) for n in aggs]), aggs)


# --- account roll-ups ------------------------------------------------------

def due_rollup_aggregates(as_of, tracked_lender: int, cutoff) -> tuple[dict[str, Column], dict[str, Column]]:
    """(days, sums): outstanding totals, overdue sums and cycle sums over the due rows."""
    d, c = date_lit(as_of), cutoff
    due = F.col("state") == "due"
    by_now = due & (F.col("due") <= d)
    by_cycle = due & (F.col("due") <= c)
    out = {}
    out.update({f"current_total_due_{m}": F.sum(F.when(due, F.col(m))) for m in MEASURES})
    out.update({f"current_due_{m}": F.sum(F.when(by_now, F.col(m)).when(due, F.lit(0))) for m in MEASURES})
    out.update({f"current_fddue{m}": F.sum(F.when(due & (F.col("lender") == tracked_lender), F.col(m)).when(due, F.lit(0)))
                for m in MEASURES})
    out.update({f"pt_current_due{m}": F.sum(F.when(by_cycle, F.col(m)).when(due, F.lit(0))) for m in ("amount", "principal")})
    days = {
        "emi_due_date": F.min(F.when(due, F.col("due"))),
        "emi_duedate_first": F.min(F.when(by_now, F.col("due"))),
        "emi_duedate_last": F.max(F.when(by_now, F.col("due"))),
        "pt_due_date_since": F.min(F.when(by_cycle, F.col("due"))),
        "pt_last_due_date": F.max(F.when(by_cycle, F.col("due"))),
    }
    return days, out


# How day figures combine when months are combined to accounts.
LOWEST = {"first_emi_date", "emi_due_date", "emi_duedate_first", "pt_due_date_since"}
HIGHEST = {"last_emi_date", "last_paid_date", "emi_duedate_last", "pt_last_due_date"}


def combine(name: str) -> Column:
    if name in LOWEST:
        return F.min(name).alias(name)
    return (F.max(name) if name in HIGHEST else F.sum(name)).alias(name)


def due_rollup(df: DataFrame, as_of, tracked_lender: int, cutoff) -> DataFrame:
    """Outstanding position of the accounts that have due rows."""
    days, sums = due_rollup_aggregates(as_of, tracked_lender, cutoff)
    m = by_month(df.filter(F.col("state") == "due"), days, sums, minor=True)
    return in_money(m.groupBy("loan_id").agg(*[combine(n) for n in (*days, *sums)]), sums)


def loan_totals(df: DataFrame) -> DataFrame:
    """Totals, first and last day and last payment per account."""
    days, sums = total_aggregates()
    return in_money(by_month(df, days, sums, minor=True).groupBy("loan_id").agg(*[combine(n) for n in (*days, *sums)]), sums)


def total_aggregates() -> tuple[dict[str, Column], dict[str, Column]]:
    """(days, sums): total and paid sums with sign guards, first and last day, last payment."""
    st = F.col("state")
    paid_day = F.when(st == "paid", F.col("updated"))
    out = {
        "amount_total": F.sum(F.when((st != "closed") & (F.col("amount") >= 0), F.col("amount")).otherwise(0)),
        "principal_total": F.sum(F.when((st != "closed") & (F.col("principal") >= 0), F.col("principal")).otherwise(0)),
        "interest_total": F.sum(F.when((st != "closed") & (F.col("interest") > 0), F.col("interest")).otherwise(0)),
    }
    for m, name in (("amount", "emi_total_paid"), ("principal", "principal_total_paid"), ("interest", "interest_total_paid")):
        out[name] = F.sum(F.when((st == "paid") & (F.col(m) >= 0), F.col(m)).otherwise(0))
    return {"first_emi_date": F.min("due"), "last_emi_date": F.max("due"), "last_paid_date": F.max(paid_day)}, out


def due_month(df: DataFrame) -> Column:
    """The due month: the column that rows are already partitioned by, where there is one."""
    return F.col("emi_month") if "emi_month" in df.columns else month_start("due").alias("emi_month")


def by_month(df: DataFrame, aggs: dict, sums: dict | None = None, minor: bool = False) -> DataFrame:
    """Installments at (loan, month) grain: the only pass over raw rows.

    The shuffle key is (loan, month), so an account with very many rows is spread over
    its months, and what follows sees at most one row per account and calendar month.
    Rows that ``sources.installments`` made distinct under that key are not moved again.
    ``sums`` are money sums; they run in minor units here and are money afterwards.  ``minor`` leaves them as whole hundredths,
    for callers that add months up to accounts: there are many more months than accounts, and a long takes a third of the space.
    """
    sums = sums or {}
    grouped = (in_minor_units(df).groupBy("loan_id", due_month(df))
               .agg(*[a.alias(n) for n, a in {**aggs, **sums}.items()]))
    return grouped.select("loan_id", "emi_month", *aggs, *[F.col(n) if minor else money(n).alias(n) for n in sums])


def month_numbers(monthly: DataFrame, running: dict | None = None) -> DataFrame:
    """Number the months of an account, rows without a due day last; ``running`` adds running sums (name -> column)."""
    w = Window.partitionBy("loan_id").orderBy(F.col("emi_month").asc_nulls_last())
    out = monthly.withColumn("emi_no", F.row_number().over(w))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, c in (running or {}).items():
        out = out.withColumn(name, F.sum(c).over(upto))
    return out


def representative_installment(second: Column, third: Column, first: Column) -> Column:
    """The smaller of the second and third installment where positive, else the first.

    Without a second or third month the sums are zero, so short accounts use the first.
    """
    pick = F.when(second <= third, second).otherwise(third)
    return F.when(pick > 0, pick).otherwise(first)


def last_installment_amount(df: DataFrame) -> DataFrame:
    """Amount due in the last month of an account."""
    m = by_month(df, {}, {"emi_amount": F.sum("amount")}, minor=True)
    return m.groupBy("loan_id").agg(money(F.max_by("emi_amount", "emi_month")).alias("emi"))


def fee_totals(txns: DataFrame, types: dict = fv.FEE_TYPES, settled: int = fv.SETTLED_TXN_STATE) -> DataFrame:
    """Settled fees by transaction type, rounded to whole units."""
    return (txns.filter((F.col("deleted") == "N") & (F.col("txn_state") == settled))
            .groupBy("loan_id")
            .agg(*[F.round(F.sum(F.when(F.col("txn_type") == t, F.col("txn_amount")).otherwise(F.lit(0))), 0).alias(n)
                   for n, t in types.items()]))


def register_rollup(register: DataFrame, ignored_payees, states=fv.PAYMENT_STATES,
                    offset_s: int = fv.IST_OFFSET_S) -> DataFrame:
    """First and last disbursal day and amount per loan from the payment register."""
    day = epoch_to_local_date(F.col("payment_instrument_date").try_cast("long"), offset_s)
    return (register.filter((F.col("deleted") == "N") & F.col("payment_status").isin(list(states))
                            & ~F.col("pay_user_id").isin(list(ignored_payees)))
            .groupBy("loan_id")
            .agg(F.min(day).alias("first_disburse_date"), F.max(day).alias("last_disburse_date"),
                 F.sum("instrument_amount").alias("disburse_amount")))


def collected_proposals(proposals: DataFrame, collections: DataFrame) -> DataFrame:
    """Accepted and collected proposals next to their collections (1:n)."""
    p = (proposals.filter((F.col("deleted") == "N") & (F.col("proposal_state") == "13000") & (F.col("is_collected") == "Y"))
         .select(F.col("id").cast("long").alias("proposal_id"), "loan_id", F.col("lender_uid").alias("lender"),
                 F.col("amount").alias("cp_amount")))
    c = (collections.filter((F.col("deleted") == "N") & (F.col("proposal_state") == "14000") & (F.col("is_declined") == "0"))
         .select(F.col("proposal_id").try_cast("long").alias("proposal_id"),
                 epoch_to_local_date("udated", 0).alias("collection_day")))
    return p.join(c, "proposal_id")


def proposal_rollup(joined: DataFrame, priority, default: str) -> DataFrame:
    """First / last collection day, amount over the joined rows, and portfolio per loan."""
    return joined.groupBy("loan_id").agg(
        F.min("collection_day").alias("first_day"), F.max("collection_day").alias("last_day"),
        F.sum("cp_amount").alias("proposal_amount"), portfolio_tag(priority, default=default).alias("portfolio_type"))
