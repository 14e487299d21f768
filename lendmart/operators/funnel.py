"""Lead funnel: campaigns, prospects, acceptance, registrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions.dates import days_between, epoch_to_local_date
from lendmart.functions.text import filled
from lendmart.operators.rows import active_only, earliest_match, latest_by


def campaign_dates(runs: DataFrame, performance: DataFrame, min_id: int = 2,
                   offset_s: int = -fv.IST_OFFSET_S) -> DataFrame:
    """Earliest campaign day per application over two feeds.

    One feed carries text days, the other epoch seconds with the offset taken off.
    """
    a = runs.select(F.col("los_app_id").cast("long").alias("los_app_id"),
                    F.try_to_date("campaign_date", "yyyy-MM-dd").alias("day"))
    b = active_only(performance).filter(F.col("id") > min_id).select(
        F.col("los_app_id").try_cast("long").alias("los_app_id"),
        epoch_to_local_date(F.col("campaign_date").try_cast("long"), offset_s).alias("day"))
    return a.unionByName(b).groupBy("los_app_id").agg(F.min("day").alias("campaign_date"))


PROSPECT_COLUMNS = {
    "los_app_id": "los_app_id", "applicant_name": "pros_name", "user_dob": "pros_dob", "user_age": "pros_age",
    "pan": "pros_pan", "mobile": "pros_mobile", "user_date": "pros_registration_date",
    "user_vintage": "pros_vintage", "user_pin": "pros_pin", "registration_type": "pros_registration_type",
    "employement_type": "pros_employement_type", "employment_sub_type": "pros_employment_sub_type",
    "score_date": "pros_score_date", "bureau_score": "pros_score", "score_description": "pros_score_description",
    "cs_score_date": "pros_cs_score_date", "cs_score": "pros_cs_score", "propensity": "pros_propensity",
}


def prospect_base(prospects: DataFrame, campaigns: DataFrame, columns: dict = PROSPECT_COLUMNS,
                  national_id: str = "pros_pan") -> DataFrame:
    """Prospects with their campaign day; the first prospect of a national id has number 1.

    Undated campaigns come last.  Only number 1 is used downstream, so rows are marked by
    comparing with the winner of their id instead of sorting whole groups.
    """
    p = prospects.select(*[F.col(s).alias(n) for s, n in columns.items()])
    p = p.join(campaigns, p["los_app_id"].cast("long") == campaigns["los_app_id"], "left").drop(campaigns["los_app_id"])
    order = [F.col("campaign_date").asc_nulls_last(), F.col("los_app_id").asc()]
    first = latest_by(p.filter(filled(national_id)), national_id, order).select(
        national_id, F.col("los_app_id").alias("__first"))
    return (p.join(first, national_id, "left")
            .withColumn("is_first_of_id", F.when(F.col("__first").isNotNull(),
                                                 (F.col("__first") == F.col("los_app_id")).cast("int")))
            .drop("__first"))


def attribute_campaign(leads: DataFrame, prospects: DataFrame, phone: str = "lead_mobile_clean",
                       national_id: str = "lead_pan", carry=None) -> DataFrame:
    """The prospect with the earliest campaign reachable by phone or by national id, per lead."""
    carry = carry or [c for c in prospects.columns if c != "is_first_of_id"]
    return earliest_match(
        leads, prospects,
        [(phone, "pros_mobile", None), (national_id, "pros_pan", F.col("is_first_of_id") == 1)],
        ["campaign_date", "los_app_id"], carry)


def campaign_window(days: int = fv.CAMPAIGN_WINDOW_DAYS, campaign="campaign_date",
                    registered="lead_registration_date") -> dict[str, Column]:
    """Registered within the window after the campaign, and the distance in days."""
    gap = days_between(campaign, registered)
    return {"campaign_lead": F.when(gap.between(0, days), 1).otherwise(0), "camp_lead_diff": gap}


def acceptance(log: DataFrame, leads: DataFrame, state: int = fv.ACCEPTED_STATE) -> DataFrame:
    """Latest day a recent lead entered the accepted state (any logged entity type)."""
    hit = log.filter(F.col("new_state") == state).select(F.col("entity").alias("loan_id"), F.to_date("at").alias("day"))
    # Aggregated first, so the semi join compares one row per loan.
    latest = hit.groupBy("loan_id").agg(F.max("day").alias("acc_date"))
    return latest.join(leads.select("loan_id"), "loan_id", "left_semi")


def first_registration(leads: DataFrame, everyone: DataFrame, phone: str = "lead_mobile_clean",
                       national_id: str = "lead_pan") -> DataFrame:
    """Earliest application of the same phone or national id, per lead.

    ``everyone``: ``loan_id, user_id, loan_registered_date, bor_mobile, user_pan``.
    """
    e = everyone.select(F.col("user_id").alias("uid"), "loan_registered_date", "bor_mobile", "user_pan",
                        F.col("loan_id").alias("first_loan_id"))
    out = earliest_match(
        leads, e,
        [(phone, "bor_mobile", None), (national_id, "user_pan", F.col("user_pan") != "")],
        ["loan_registered_date", "first_loan_id"], ["uid", "loan_registered_date", "first_loan_id"])
    return (out.withColumn("loan_registered_month", F.trunc("loan_registered_date", "month"))
               .withColumn("loan_lead_diff", days_between("loan_registered_date", "lead_registration_date")))
