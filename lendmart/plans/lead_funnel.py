"""Mart: one row per recent lead with rules, acceptance, disbursal and campaign attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmart.config import DEFAULT_SITE, SiteConfig
from lendmart.functions.dates import date_lit
from lendmart.operators import funnel
from lendmart.operators import state_log as sl
from lendmart.operators.rows import active_only, latest_by
from lendmart.sources.catalog import Catalog

# Lead columns of the funnel and where they come from.
LEAD_COLUMNS = {
    "loan_id": "loan_id", "lead_registration_date": "loan_registered_date", "lead_stage": "loan_currentstate",
    "lead_name": "user_name", "lead_mobile": "user_mobile", "lead_mobile_clean": "bor_mobile", "lead_pan": "user_pan",
    "lead_dob": "user_dob", "lead_registration_age": "age_loanregister", "lead_current_age": "age_current",
    "lead_pin": "user_pin", "lead_city": "user_city", "lead_final_city": "user_final_city", "lead_state": "user_state",
    "lead_final_state": "user_final_state", "lead_source": "source", "lead_dsa": "user_agent_name",
    "lead_sub_dsa": "user_agents_name", "lead_sub_category": "sub_category", "lead_category": "category",
    "lead_channel": "channel", "lead_rm": "rm", "lead_employement": "employement_type",
}


def recent_leads(leads: DataFrame, since: str) -> DataFrame:
    out = leads.filter(F.col("loan_registered_date") >= date_lit(since)).select(
        *[F.col(s).alias(n) for n, s in LEAD_COLUMNS.items()])
    return out.withColumn("lead_registration_month", F.trunc("lead_registration_date", "month"))


def lead_funnel(catalog: Catalog, site: SiteConfig = DEFAULT_SITE) -> DataFrame:
    everyone = catalog["lead_details"]
    leads = recent_leads(everyone, site.funnel_from)
    # The logs hold every loan ever; only the recent leads' rows are ranked.  Ids may repeat: a semi join does not mind,
    # and Spark builds a Bloom filter over a plain scan of them that drops the other rows where the log is read.
    ids = leads.select("loan_id")
    rules = sl.pivot_outcomes(sl.latest_rule_by_type(catalog["lender_rule_log"].join(ids, "loan_id", "left_semi")))
    # Acceptance counts whatever entity type was logged, on unshifted days.
    log = sl.state_log(catalog["state_log"], entity_types=None, offset_s=0)
    accepted = funnel.acceptance(log, leads)
    # One disbursal per lead: the newest, so the join keeps the row count.
    disb = active_only(catalog["lender_eligibility"]).filter(F.col("disburse_status") == "Y").join(ids, "loan_id", "left_semi")
    disb = latest_by(disb.select("loan_id", "product_tag", "disburse_amount", "disburse_date"), "loan_id",
                     [F.col("disburse_date").desc_nulls_last(), F.col("product_tag").asc(), F.col("disburse_amount").desc()])
    out = leads.join(accepted, "loan_id", "left").join(rules, "loan_id", "left").join(disb, "loan_id", "left")
    for src, month in (("bre_date", "bre_month"), ("acc_date", "acc_month"), ("disburse_date", "disb_month")):
        out = out.withColumn(month, F.trunc(src, "month"))
    out = out.withColumn("accepted", F.when(F.col("acc_date").isNotNull(), 1).otherwise(0))
    prospects = funnel.prospect_base(catalog["prospects"],
                                     funnel.campaign_dates(catalog["campaign_runs"], catalog["campaign_performance"]))
    out = funnel.attribute_campaign(out, prospects)
    for n, c in {**funnel.campaign_window(), **sl.eligibility_score()}.items():
        out = out.withColumn(n, c)
    return funnel.first_registration(out, everyone)
