"""Mart: loan x month-end with cohort bands and repeat-borrower history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.config import DEFAULT_SITE, SiteConfig
from lendmart.functions import bands
from lendmart.functions.dates import date_lit, days_between, fiscal_calendar, month_end, months_between
from lendmart.functions.text import extract_decimal, filled
from lendmart.operators import cohorts
from lendmart.sources.catalog import Catalog


def repeat_history(monthly: DataFrame, leads: DataFrame, as_of) -> DataFrame:
    """Repeat-borrower attributes per loan, from its row of the current month."""
    now = monthly.filter(F.col("status_month") == F.last_day(date_lit(as_of))).select(
        "loan_id", "disburse_date", "loan_close_date", "last_emi_date")
    who = leads.filter((F.col("channel") != "Alliances") & (F.col("user_pan") != "")).select(
        "loan_id", "user_pan", "sub_category", "category", "channel")
    out = cohorts.repeat_borrower(now.join(who, "loan_id"), "user_pan", "disburse_date")
    return out.select("loan_id", "pan_count", "top_up", "old_category", "old_sub_category", "old_channel",
                      "old_loan_last_emi_date", "old_loan_close_date", "top_date_diff")


def lead_attributes(leads: DataFrame, register: DataFrame, as_of, site: SiteConfig) -> DataFrame:
    """Everything of the pool that depends on the application alone: computed once per loan."""
    df = leads.filter((F.col("plus") != fv.EXCLUDED_DISPOSITION) & (F.col("fraud_flag") == 0))
    df = cohorts.co_lender_score(df, site.partner_source, site.co_lender_excluded_loans, parent_scores=leads)
    df = cohorts.mandate_presented(df, cohorts.presented_mandates(register, as_of))
    income = extract_decimal("income")
    before, after = (F.col(c).try_cast("decimal(10,3)") for c in ("foir_before", "foir_after"))
    live = F.to_date("uw_live_date")
    tat = days_between("loan_registered_date", "first_disburse_date")
    tat_live = days_between(live, "first_disburse_date")
    tat_loan = days_between("loan_registered_date", live)
    vintage = months_between("comp_startdate", "loan_registered_date")

    def na(c):
        return F.coalesce(F.col(c), F.lit("NA"))

    return df.select(
        "loan_id", "gender", "generations", F.col("user_pin").alias("pincode"), F.col("user_city").alias("borrower_city"),
        F.col("user_district").alias("borrower_district"), F.col("user_state").alias("borrower_state"),
        F.col("user_zone").alias("borrower_zone"), "residence_type", "employement_type", F.lit("").alias("cirf_score"),
        "crif_score_original", "loan_type", "loan_city", F.col("tenure_months").alias("tenure"),
        bands.tenure_band("tenure_monthsno").alias("tenure_group"), F.col("rate_max_approved").alias("roi"),
        "risk_bucket", "sub_category", "source", "category", F.col("channel").alias("channel_old"),
        bands.age_band("age_loanregister").alias("age_group"),
        F.when(filled("income"), income).alias("income"),
        bands.income_band("employement_type", income, "income").alias("income_group"),
        F.when(filled("foir_before"), before).alias("foir_before"),
        bands.obligation_before_band("employement_type", before, "foir_before").alias("foir_before_group"),
        F.when(filled("foir_after"), after).alias("foir_after"),
        bands.obligation_after_band("employement_type", after, "foir_after").alias("foir_after_group"),
        F.lit("").alias("crif_group"),
        tat.alias("tat"), bands.turnaround_band(tat).alias("tat_grp"),
        tat_live.alias("tat_live_disburse"), bands.turnaround_band(tat_live).alias("tat_grp_live_disburse"),
        tat_loan.alias("tat_loan_live"), bands.turnaround_band(tat_loan).alias("tat_grp_loan_live"),
        "dev_exists", "total_dev", "bank_name", na("nach_source").alias("nach_type"), na("nach_status").alias("nach_status"),
        na("nach_reason").alias("nach_reason"), na("payment_registration_method").alias("payment_registration_method"),
        "payment_presentation_method", "cheque_total", "cheque_available",
        F.when(F.col("cheque_available") > 0, "Yes").otherwise("No").alias("cheque_available_flag"),
        F.when(F.col("dev_exists") == "Y", 1).otherwise(0).alias("deviation_exists"),
        F.col("total_dev").alias("total_deviation"), "loan_registered_date",
        *[F.to_date(c).alias(c) for c in ("accepted_date", "actual_live_date", "rfd_date")],
        "first_disburse_date", "product_type", F.col("comp_natureofbusiness").alias("nature_of_business"),
        F.col("comp_industrytype").alias("industry_type"), "ex360_npa", F.col("uw_name").alias("__uw_name"),
        F.col("uw_status_final").alias("uw_status"), F.col("call_disposition").alias("call_status"),
        F.col("ba_name").alias("borrower_agent"), F.col("ba_login_name_clean").alias("borrower_agent_name"),
        F.col("rm").alias("relation_manager"),
        (F.when(F.col("loan_img1") == "APPROVED", "PQ Approved").when(F.col("loan_img1") == "APPROVED_STPQ", "STPQ Approved")
          .when(F.col("loan_img1").isin("REFER", "REJECTED"), F.col("loan_img1"))
          .when(F.col("loan_img1").isNotNull(), "Unknown").otherwise("NA")).alias("pq_status"),
        (F.when(F.col("loan_img2").isin("YES", "NO"), F.initcap("loan_img2"))
          .when(F.col("loan_img2").isNotNull(), "Unknown").otherwise("NA")).alias("offer_status"),
        F.when(F.col("uw_returned_date").isNotNull(), 1).otherwise(0).alias("retuned_flag"),
        F.when(F.col("uw_forward_to_cs_date").isNotNull(), 1).otherwise(0).alias("forwarded_flag"),
        vintage.alias("business_vintage"), bands.vintage_band(vintage).alias("business_vintage_grp"),
        F.nullif(F.col("user_agent_name"), F.lit("")).alias("__dsa"),
        bands.score_band("crif_score_original").alias("crif_group_original"))


def static_pool(catalog: Catalog, as_of, site: SiteConfig = DEFAULT_SITE) -> DataFrame:
    """Loan-months joined to application attributes and repeat history, all keyed by loan."""
    monthly, leads = catalog["loan_details_at_monthly"], catalog["lead_details"]
    apps = lead_attributes(leads, catalog["mandate_ledger"], as_of, site)
    history = repeat_history(monthly, leads, as_of)
    m = monthly.select(
        "loan_id", "portfolio_type", F.col("loan_total_principal").alias("loan_amount"), "disburse_date",
        F.when(F.col("loan_status") == "Active", 1).otherwise(0).alias("loan_status"),
        F.col("total_due_principal").alias("pos"), F.col("roi").alias("__roi"), F.col("channel").alias("__channel"),
        "first_emi_date", F.col("bounce_relaxed").alias("bounce_mob"), "status_month", "mob",
        F.col("loan_status").alias("loan_status_mob"), F.col("dpdcurrent_classification").alias("dpd"),
        F.col("mob_emi").alias("mob_on_1st_emi"), "due_principal_to_collect", "dpd_month_current")
    df = m.join(apps.join(history, "loan_id", "left"), "loan_id")
    df = df.withColumn("disburse_month", month_end("disburse_date"))
    small = F.col("loan_amount") < fv.SMALL_TICKET_LIMIT
    derived = {
        **fiscal_calendar("disburse_month"),
        "channel": F.when((F.col("channel_old") != "Alliances") & small, "Pocket Loan")
                    .when(F.col("channel_old") == site.organic_channel, "Organic").otherwise(F.col("channel_old")),
        "roi_group": bands.roi_band("__roi"),
        "loan_amount_group_new": bands.amount_band("loan_amount"),
        **cohorts.non_starter("loan_amount", "pos", "first_emi_date", "status_month"),
        "pos_mob": F.col("pos"),
        "uw": F.when(F.col("__channel") == "Alliances", "Alliances").when(small, "Pocket Loan").otherwise(F.col("__uw_name")),
        "dsa": F.when(F.col("__channel") == site.agent_channel[0], F.col("__dsa")),
        "double_disburse": F.when(F.col("top_date_diff") > 10, 1).otherwise(0),
        **bands.delinquency_flags("dpd", "pos"),
        "ex365_month": F.when(F.col("dpd_month_current") >= 365, 1).otherwise(0),
    }
    df = df.select("*", *[c.alias(n) for n, c in derived.items()])
    return df.drop("__roi", "__channel", "__uw_name", "__dsa", "disburse_date", "first_emi_date", "dpd_month_current")
