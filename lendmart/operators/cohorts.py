"""Cohorts: repeat borrowers, first-payment defaulters, co-lender scores, presentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions.dates import date_lit, days_between, month_start, text_epoch_to_date
from lendmart.operators.rows import numbered_with_previous


def repeat_borrower(loans: DataFrame, identity: str, day: str, tie: str = "loan_id",
                    open_gap: int = 30) -> DataFrame:
    """Sequence number per identity, repeat flag, attributes of the loan before, day gap.

    Expects ``sub_category, category, channel, last_emi_date, loan_close_date``.  The gap
    is the previous close minus this disbursal (negative when closed earlier),
    ``open_gap`` when the previous loan is still open, 0 for a first loan.
    """
    out = numbered_with_previous(loans, identity, day, tie, "pan_count", {
        "old_sub_category": "sub_category", "old_category": "category", "old_channel": "channel",
        "old_loan_last_emi_date": "last_emi_date", "old_loan_close_date": "loan_close_date"})
    repeat = F.col("pan_count") > 1
    return (out.withColumn("top_up", F.when(repeat, 1).otherwise(0))
               .withColumn("top_date_diff",
                           F.when(repeat & F.col("old_loan_close_date").isNotNull(),
                                  days_between(day, "old_loan_close_date"))
                            .when(repeat, open_gap).otherwise(0)))


def non_starter(total_principal, due_principal, first_due, status_month, grace: int = 4) -> dict[str, Column]:
    """Nothing repaid although the first installment fell due at least ``grace`` days ago."""
    presented = F.col(first_due) <= F.date_sub(F.col(status_month), grace)
    hit = presented & (F.col(total_principal) == F.col(due_principal))
    return {
        "la_1stemipresented": F.when(presented, F.col(total_principal)).otherwise(F.lit(0)),
        "non_starter_flag": F.when(hit, "Yes").otherwise("No"),
        "non_starter": F.when(hit, 1).otherwise(0),
        "non_starter_pos": F.when(hit, F.col(due_principal)).otherwise(F.lit(0)),
    }


def co_lender_score(leads: DataFrame, partner_source: str, excluded_loans, parent_scores: DataFrame | None = None) -> DataFrame:
    """Own bureau score, or the parent applicant's for partner-sourced leads, as a number.

    The parent side is reduced to one score per user (the highest loan id) so the join
    keeps the row count.
    """
    src = leads if parent_scores is None else parent_scores
    parents = (src.filter(~F.col("loan_id").isin(list(excluded_loans)))
               .groupBy(F.col("user_id").alias("parent_uid"))
               .agg(F.max_by(F.struct(F.col("crif_score").alias("v")), F.col("loan_id")).alias("__p")))
    linked = (F.col("source") == partner_source) & (F.col("parent_uid") != 0)
    # Only linked leads look for a parent, so the many leads without one never meet the join key.
    found = (leads.filter(linked).select("loan_id", "parent_uid").join(parents, "parent_uid")
             .select("loan_id", F.col("__p")["v"].try_cast("int").alias("__parent")))
    return (leads.join(found, "loan_id", "left")
            .withColumn("crif_score_original",
                        F.when(linked, F.col("__parent")).otherwise(F.col("crif_score").try_cast("int")))
            .drop("__parent"))


def presented_mandates(register: DataFrame, as_of) -> DataFrame:
    """Mandates with a non-penalty ledger entry on or before the start of the month."""
    day = text_epoch_to_date("created", fv.IST_OFFSET_S)
    return (register.filter((F.col("deleted") == "N") & (F.col("ledger_type") != "PENALTY")
                            & (day <= month_start(date_lit(as_of))))
            .select("loan_id", "unique_reference_no").distinct())


def mandate_presented(df: DataFrame, presented: DataFrame, reference: str = "mandate_id") -> DataFrame:
    """NACH where the mandate of the loan was presented, else Others."""
    p = presented.select("loan_id", F.col("unique_reference_no").alias(reference), F.lit(1).alias("__p"))
    return (df.join(p, ["loan_id", reference], "left")
            .withColumn("payment_presentation_method", F.when(F.col("__p") == 1, "NACH").otherwise("Others"))
            .drop("__p"))
