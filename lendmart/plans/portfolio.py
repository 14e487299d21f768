"""Marts on installments: disbursals, loans, collections, loan x month snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.config import DEFAULT_SITE, SiteConfig
from lendmart.functions import bands
from lendmart.functions.dates import (cycle_cutoff, date_lit, days_between, epoch_to_local_date, month_end,
                                      month_label, months_between)
from lendmart.functions.text import percent_rate
from lendmart.operators import installments as ins
from lendmart.operators import snapshots as snap
from lendmart.operators.rows import active_only, dictionary_slice
from lendmart.sources.catalog import Catalog, installments

MEASURES = ins.MEASURES
LEAD_ATTRIBUTES = ["loan_registered_date", "loan_type", "loan_city", "rate_max_approved", "risk_bucket",
                   "source", "sub_category", "category", "channel"]


def _leads(catalog: Catalog, columns) -> DataFrame:
    df = catalog.table("lead_details")
    return df.select(F.col("loan_id").try_cast("long").alias("loan_id"), *[c for c in columns])


def disburse_master(catalog: Catalog) -> DataFrame:
    """One row per disbursed loan: days, amount, rate, installment, tenure."""
    joined = ins.collected_proposals(catalog["proposals"], catalog["proposal_collections"])
    rollup = joined.groupBy(F.col("loan_id").try_cast("long").alias("loan_id")).agg(
        F.min("collection_day").alias("first_disburse_date"), F.max("collection_day").alias("last_disburse_date"),
        F.sum("cp_amount").alias("disburse_amount"))
    loans = active_only(catalog["loans"]).select(
        F.col("id").alias("loan_id"), epoch_to_local_date("created", 0).alias("loan_created"),
        F.col("max_irate_approved").cast("string").alias("rate_code"), F.col("tenure").alias("tenure_code"))
    rates = dictionary_slice(active_only(catalog["dictionary"]), "INTREST_RATE").select(
        F.col("__code").alias("rate_code"), percent_rate("__label").alias("rate"))
    tenures = catalog["tenure_master"].select("tenure_code", F.col("tenure").alias("tenure_m"))
    out = (loans.join(rollup, "loan_id")
           .join(rates, "rate_code", "left").join(tenures, "tenure_code", "left")
           .join(ins.last_installment_amount(installments(catalog)), "loan_id", "left"))
    return out.select(
        "loan_id", "loan_created", "first_disburse_date", month_label("first_disburse_date").alias("first_disburse_month"),
        "last_disburse_date", month_label("last_disburse_date").alias("last_disburse_month"), "disburse_amount",
        F.concat(F.coalesce("rate", F.lit(0).cast("decimal(10,2)")).cast("string"), F.lit("%")).alias("roi"),
        "emi", F.coalesce("tenure_m", F.lit(0)).alias("tenure_months"))


def loan_position(inst: DataFrame, as_of, site: SiteConfig = DEFAULT_SITE, cycle_day: int = 25) -> DataFrame:
    """Totals, outstanding sums and cycle figures of a loan on a day."""
    d = date_lit(as_of)
    total_days, total_sums = ins.total_aggregates()
    due_days, due_sums = ins.due_rollup_aggregates(as_of, site.tracked_lender, cycle_cutoff(as_of, cycle_day))
    days, sums = {**total_days, **due_days}, {**total_sums, **due_sums}
    due, st = F.col("state") == "due", F.col("state")
    month_aggs = {
        **days,
        "has_due": F.max(F.when(due, 1).otherwise(0)),
        "first_paid_probe": F.max(F.when(due, F.lit(fv.FIRST_STILL_DUE_SENTINEL).cast("date"))
                                  .when(st == "paid", F.col("updated"))
                                  .otherwise(F.lit(fv.PAID_SENTINEL).cast("date"))),
        **{f"has_{i}": F.max(F.when(F.col("lender") == uid, 1).otherwise(0))
           for i, (uid, _) in enumerate(site.priority_lenders)},
    }
    months = ins.month_numbers(ins.by_month(inst, month_aggs, {**sums, "month_amount": F.sum("amount")}, minor=True))
    tag = None
    for i, (_, label) in enumerate(site.priority_lenders):
        c = F.max(f"has_{i}") > 0
        tag = F.when(c, label) if tag is None else tag.when(c, label)
    nth = {f"emi_{n}": F.sum(F.when(F.col("emi_no") == n, F.col("month_amount")).otherwise(F.lit(0))) for n in (1, 2, 3)}
    due_no = F.when(F.col("has_due") == 1, F.col("emi_no"))
    loans = months.groupBy("loan_id").agg(
        tag.otherwise(site.other_portfolio).alias("portfolio_type"),
        *[ins.combine(n) for n in (*days, *sums)],
        *[a.alias(n) for n, a in nth.items()],
        F.max("emi_no").alias("count_total_emi"), F.min(due_no).alias("due_lo"), F.max(due_no).alias("due_hi"),
        F.max(F.when(F.col("emi_no") == 1, F.col("first_paid_probe"))
              .otherwise(F.lit(fv.NOT_FIRST_SENTINEL).cast("date"))).alias("first_emi_paid_date"))
    loans = ins.in_money(loans, (*sums, *nth))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in
            [f"current_total_due_{m}" for m in MEASURES] + [f"current_due_{m}" for m in MEASURES]
            + [f"pt_current_due{m}" for m in ("amount", "principal")]}
    return loans.select(
        "loan_id", "portfolio_type", F.col("count_total_emi").cast("long"),
        F.coalesce(F.col("due_lo") - 1, F.col("count_total_emi")).cast("long").alias("count_paid_emi"),
        F.coalesce(F.col("count_total_emi") - F.col("due_lo") + 1, F.lit(0)).cast("long").alias("count_balance_emi"),
        F.col("emi_1").alias("first_emi_amount"),
        ins.representative_installment(F.col("emi_2"), F.col("emi_3"), F.col("emi_1")).alias("loan_emi_amount"),
        "amount_total", "principal_total", "interest_total", "emi_total_paid", "principal_total_paid",
        "interest_total_paid", "first_emi_date", "last_emi_date", "last_paid_date", *zero.values(),
        "emi_due_date",
        F.when(F.col("emi_due_date") <= d, days_between("emi_due_date", d)).alias("dpd_current"),
        F.coalesce(F.col("due_hi") - F.col("due_lo") + 1, F.lit(0)).cast("long").alias("count_of_emi_total_due"),
        "emi_duedate_first", "emi_duedate_last",
        F.coalesce(months_between("emi_duedate_first", "emi_duedate_last") + 1, F.lit(0)).cast("long").alias("count_of_emi_due"),
        "pt_due_date_since", "pt_last_due_date",
        (months_between("pt_due_date_since", "pt_last_due_date") + 1).cast("long").alias("pt_count_of_emi_due"),
        "first_emi_paid_date")


def loan_details(catalog: Catalog, as_of, site: SiteConfig = DEFAULT_SITE) -> DataFrame:
    """Mart: one row per loan with installments, as of a day."""
    pos = loan_position(installments(catalog), as_of, site)
    lead = _leads(catalog, ["loan_type", "loan_city", "loan_registered_date", "actual_live_date", "first_disburse_date",
                            "first_disburse_month", "rate_max_approved", "risk_bucket", "loan_amount_expected",
                            "max_amount_approved", "disburse_amount", "source", "sub_category", "category", "channel",
                            "cibil_score", "crif_score"])
    fees = ins.fee_totals(catalog["transactions"])
    settled = F.col("current_total_due_principal") == 0
    out = pos.join(lead, "loan_id", "left").join(fees, "loan_id", "left")
    return out.select(
        "loan_id", "portfolio_type", F.when(settled, "Closed").otherwise("Active").alias("loan_status"),
        F.col("current_total_due_principal").alias("loan_statusss"), "loan_type", "loan_city", "loan_registered_date",
        F.col("actual_live_date").alias("live_date"), F.col("first_disburse_date").alias("disburse_date"),
        month_end("first_disburse_date").alias("lastday_disburse_date"), F.col("first_disburse_month").alias("disburse_month"),
        "first_emi_date", "last_emi_date", "first_emi_paid_date",
        F.when(settled, F.col("last_paid_date")).alias("loan_close_date"), "last_paid_date",
        F.col("emi_due_date").alias("due_emi_date"), F.col("count_total_emi").alias("tenure"),
        F.concat(F.col("rate_max_approved").cast("string"), F.lit(" %")).alias("roi"), "risk_bucket",
        "first_emi_amount", "loan_emi_amount", "loan_amount_expected", "max_amount_approved", "disburse_amount",
        F.col("principal_total").alias("loan_amount"), "count_paid_emi", "count_balance_emi",
        F.col("interest_total").alias("loan_total_interest"), F.col("amount_total").alias("loan_total_amount"),
        "principal_total_paid", "interest_total_paid", F.col("emi_total_paid").alias("amount_total_paid"),
        *[F.col(f"current_total_due_{m}").alias(f"total_due_{m}") for m in ("principal", "interest", "amount")],
        *[F.col(f"current_due_{m}") for m in MEASURES],
        "count_of_emi_total_due", "emi_duedate_first", "emi_duedate_last", "count_of_emi_due", "dpd_current",
        "pt_current_dueamount", "pt_current_dueprincipal", "pt_due_date_since", "pt_last_due_date", "pt_count_of_emi_due",
        F.col("source").alias("source_of_lead"), "sub_category", "category", "channel", "cibil_score", "crif_score",
        "registration_fees", "processing_fees",
        bands.bucket_dpd("dpd_current", "loan", "first_emi_date", settled, as_of).alias("dpd_classification"))


def collection_position(inst: DataFrame, as_of, site: SiteConfig = DEFAULT_SITE, legacy_labels: bool = False) -> DataFrame:
    """Collection figures of every account with installments.

    Raw rows are reduced once to (loan, month); numbering and the account figures come
    from that grain.
    """
    d = date_lit(as_of)
    m0, m1 = F.trunc(d, "month"), F.last_day(d)
    p0, p1 = F.add_months(m0, -1), F.date_sub(m0, 1)
    st, up, cr, due = F.col("state"), F.col("updated"), F.col("created"), F.col("due")
    is_due, settled = st == "due", st != "due"
    open_start = (cr < m0) & (is_due | (settled & (up >= m0)))
    open_prev = (cr < p0) & (is_due | (settled & (up >= p0)))
    sums = ins.period_aggregates(as_of)
    month_aggs = {
        "has_due": F.max(F.when(is_due, 1).otherwise(0)),
        "has_paid": F.max(F.when(ins.is_paid(), 1).otherwise(0)),
        "due_by_month_end": F.max(F.when(is_due & (due <= m1), 1).otherwise(0)),
        "open_start": F.max(F.when(open_start, 1).otherwise(0)),
        "first": F.min("due"), "last": F.max("due"),
        "last_paid": F.max(F.when(st == "paid", up)), "last_touch": F.max(up),
        "low_due": F.min(F.when(is_due, due)),
        "low_start": F.min(F.when(open_start, due)),
        "low_prev": F.min(F.when(open_prev, due)),
        **{f"has_{i}": F.max(F.when(F.col("lender") == uid, 1).otherwise(0))
           for i, (uid, _) in enumerate(site.collection_lenders)},
    }
    months = ins.month_numbers(ins.by_month(inst, month_aggs, {**sums, "month_amount": F.sum("amount")}, minor=True),
                               {"paid_no": "has_paid", "due_no": "has_due"})
    tag = None
    for i, (_, label) in enumerate(site.collection_lenders):
        c = F.max(f"has_{i}") > 0
        tag = F.when(c, label) if tag is None else tag.when(c, label)
    no = F.col("emi_no")

    def upto(cond, number=no):
        return F.max(F.when(cond, number).otherwise(0)).cast("long")

    acc = months.groupBy("loan_id").agg(
        tag.otherwise(site.other_portfolio).alias("portfolio_type"),
        F.when(F.max("has_due") > 0, "Active").otherwise("closed").alias("loan_status"),
        F.max("emi_no").cast("long").alias("total_emi_count"),
        upto(F.col("has_due") == 0, F.col("paid_no")).alias("paid_emi_count"),
        upto(F.col("has_due") == 1, F.col("due_no")).alias("balance_emi_count"),
        F.sum(F.when(no == 1, F.col("month_amount")).otherwise(F.lit(0))).alias("first_emi_amount"),
        F.sum(F.when(no == 2, F.col("month_amount")).otherwise(F.lit(0))).alias("emi_amount"),
        F.min("first").alias("first_emi_date"), F.max("last").alias("last_emi_date"),
        *[F.sum(n).alias(n) for n in sums],
        F.max("last_paid").alias("last_paid_date"),
        F.max(F.when(F.col("has_due") == 0, F.col("last_touch"))).alias("last_paid_date_full_emi"),
        upto(F.col("has_due") == 1).alias("count_of_emi_total_due"),
        upto(F.col("due_by_month_end") == 1).alias("count_of_emi_due"),
        upto((F.col("open_start") == 1) & (F.col("emi_month") <= m0)).alias("due_emi_count_start_month"),
        F.min("low_due").alias("due_emi_date"), F.min("low_start").alias("due_emi_date_start_month"),
        F.min("low_prev").alias("low_prev"))
    acc = ins.in_money(acc, (*sums, "first_emi_amount", "emi_amount"))

    def dpd(low, month_limit, at):
        return F.when(F.trunc(low, "month") <= month_limit, days_between(low, at))

    acc = (acc.withColumn("dpd_current", dpd("due_emi_date", m0, d))
              .withColumn("dpd_previous_month_start", dpd("low_prev", p1, p0))
              .withColumn("dpd_month_start", dpd("due_emi_date_start_month", m0, m0)).drop("low_prev"))
    no_due = F.col("total_due_principal") <= 0
    no_prev = F.col("pos_previous_month") <= 0
    no_start = F.col("total_due_principal_start_month") <= 0
    fin_start = "finance_window_legacy" if legacy_labels else "finance_window"
    b = bands.bucket_dpd
    return (acc
            .withColumn("dpdcurrent_classification", b("dpd_current", "ops", "first_emi_date", no_due, d))
            .withColumn("dpdcurrent_classification_finance", b("dpd_current", "finance", "first_emi_date", no_due, d))
            .withColumn("dpd_previous_month_day_classification",
                        b("dpd_previous_month_start", "ops_window", "first_emi_date", no_prev, d, (p0, p1)))
            .withColumn("dpd_previous_month_day_classification_finance",
                        b("dpd_previous_month_start", "finance_window", "first_emi_date", no_prev, d, (p0, p1)))
            .withColumn("dpdstart_classification",
                        b("dpd_month_start", "ops_window", "first_emi_date", no_start, d, (m0, m1)))
            .withColumn("dpdstart_classification_finance",
                        b("dpd_month_start", fin_start, "first_emi_date", no_start, d, (m0, m1)))
            # Closed accounts carry their last payment as closing day, whatever the case of the label.
            .withColumn("loan_close_date", F.when(F.lower("loan_status") == "closed", F.col("last_paid_date"))))


def collection_master(catalog: Catalog, as_of, site: SiteConfig = DEFAULT_SITE, legacy_labels: bool = False) -> DataFrame:
    """Mart: collection figures of accounts disbursed before this month, or undisbursed and not future."""
    acc = collection_position(installments(catalog), as_of, site, legacy_labels)
    lead = _leads(catalog, [F.col("first_disburse_date").alias("__disb"), "plus"]).filter(
        F.col("plus") != fv.EXCLUDED_DISPOSITION)
    keep = (F.col("__disb") < F.trunc(date_lit(as_of), "month")) | (
        F.col("__disb").isNull() & (F.col("dpdstart_classification") != "A8_Future EMI"))
    return (acc.join(lead, "loan_id").filter(keep).drop("__disb", "plus")
            .withColumn("report_datetime", date_lit(as_of)))


MONTHLY_COLUMNS = [
    "loan_id", "portfolio_type", "loan_total_amount", "loan_total_principal", "loan_total_interest",
    "total_emi_count", "first_emi_date", "last_emi_date", "disburse_date", "first_disburse_date",
    "last_disburse_date", "status_month", "loan_status", "balance_emi_count", "paid_emi_count",
    "total_paid_amount", "total_paid_principal", "total_paid_interest", "total_paid_amount_this_month",
    "total_paid_principal_this_month", "total_paid_interest_this_month", "last_paid_date", "due_emi_date",
    "total_due_amount", "total_due_principal", "total_due_interest", "due_amount_to_collect",
    "due_principal_to_collect", "due_interest_to_collect", "dpd_month_current", "bounce_relaxed", "bounce_actual",
    "mob_emi", "mob", "missed_payment_relaxed", "missed_payment_actual", "loan_close_date",
    "dpdcurrent_classification", "loan_registered_date", "loan_type", "loan_city", "roi", "risk_bucket",
    "source_of_lead", "sub_category", "category", "channel",
]


def _monthly(catalog: Catalog, as_of, site: SiteConfig, only_current: bool) -> DataFrame:
    inst = installments(catalog)
    joined = ins.collected_proposals(catalog["proposals"], catalog["proposal_collections"])
    disbursed = joined.groupBy(F.col("loan_id").try_cast("long").alias("loan_id")).agg(
        F.min("collection_day").alias("first_day"), F.max("collection_day").alias("last_day"))
    months = catalog["month_ends"] if catalog.has("month_ends") else None
    frame = snap.current_frame if only_current else snap.monthly_frame
    lead = _leads(catalog, LEAD_ATTRIBUTES)
    out = frame(inst, disbursed, as_of, site.priority_lenders, site.other_portfolio, months, lead)
    d = date_lit(as_of)
    at = F.least(F.col("status_month"), d)
    active = F.col("active_count") > 0
    relaxed, actual = F.col("bounce_relax_count") > 0, F.col("bounce_act_count") > 0
    out = (out
           .withColumn("loan_status", F.when(active, "Active").otherwise("Closed"))
           .withColumn("balance_emi_count", F.col("total_emi_count") - F.col("paid_emi_count"))
           .withColumn("dpd_month_current", days_between("min_overdue_emi_date", at))
           .withColumn("bounce_relaxed", F.when(relaxed, 1).otherwise(0))
           .withColumn("bounce_actual", F.when(actual, 1).otherwise(0))
           .withColumn("loan_close_date", F.when(~active, F.col("last_paid_date")))
           .withColumn("roi", F.col("rate_max_approved")).withColumn("source_of_lead", F.col("source")))
    for n, c in {**snap.months_on_book("first_emi_date", "disburse_date", "status_month"),
                 **snap.missed_payment_flags("last_emi_date", "status_month", active, relaxed, actual)}.items():
        out = out.withColumn(n, c)
    out = out.withColumn("__first", month_end("first_emi_date"))
    out = out.withColumn("dpdcurrent_classification",
                         bands.bucket_dpd("dpd_month_current", "snapshot", "__first", ~active, F.col("status_month")))

    # One schema whichever way the month was built: both write into the same table.
    def typed(name):
        if name.startswith(("loan_total_", "total_paid_", "total_due_")) or name.endswith("_to_collect"):
            return F.col(name).cast(ins.MONEY).alias(name)
        return F.col(name).cast("long").alias(name) if name.endswith("_count") else F.col(name)

    return out.select(*[typed(c) for c in MONTHLY_COLUMNS])


def loan_at_monthly_full(catalog: Catalog, as_of, site: SiteConfig = DEFAULT_SITE) -> DataFrame:
    """Mart: every loan at every month end from its disbursal to the month of ``as_of``."""
    return _monthly(catalog, as_of, site, only_current=False)


def loan_at_monthly_current(catalog: Catalog, as_of, site: SiteConfig = DEFAULT_SITE) -> DataFrame:
    """The rows of the month of ``as_of``; write them with ``sinks.refresh_snapshots``."""
    return _monthly(catalog, as_of, site, only_current=True)
