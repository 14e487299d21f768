"""Data-driven CASE builders: bands, code maps and delinquency bucket schemes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions.dates import col, date_lit


def band(c, le=(), lt=(), otherwise: str | None = None, null_label: str | None = None) -> Column:
    """First band whose edge the value does not exceed.

    ``lt`` edges are exclusive and tested before the inclusive ``le`` edges.  NULL takes
    ``null_label`` when given, else it falls through to ``otherwise``.
    """
    c = col(c)
    out = None
    steps = [(c < F.lit(e), label) for e, label in lt] + [(c <= F.lit(e), label) for e, label in le]
    if null_label is not None:
        steps.insert(0, (c.isNull(), null_label))
    for cond, label in steps:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit(otherwise)) if otherwise is not None else out


def classify(c, classes, otherwise=None) -> Column:
    """Map lists of codes to a label: ``[([codes], label), ...]``."""
    c = col(c)
    out = None
    for codes, label in classes:
        cond = c.isin(list(codes))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise)) if otherwise is not None else out


def lookup(c, mapping: dict, otherwise=None) -> Column:
    return classify(c, [([k], v) for k, v in mapping.items()], otherwise)


def risk_bucket(rate) -> Column:
    return band(rate, lt=fv.RISK_RATE_LT, le=fv.RISK_RATE_LE, otherwise="Unrated")


def tenure_band(c) -> Column:
    return band(c, le=fv.TENURE_LE)


def roi_band(c) -> Column:
    return band(c, lt=fv.ROI_LT, le=fv.ROI_LE, otherwise=fv.ROI_ELSE)


def age_band(c) -> Column:
    return band(c, lt=fv.AGE_LT, otherwise=fv.AGE_ELSE)


def amount_band(c) -> Column:
    return band(c, lt=fv.AMOUNT_LT, otherwise=fv.AMOUNT_ELSE)


def score_band(c) -> Column:
    return band(c, le=fv.SCORE_LE, otherwise=fv.SCORE_ELSE, null_label=fv.SCORE_NULL)


def turnaround_band(c) -> Column:
    return band(c, le=fv.TURNAROUND_LE, otherwise=fv.TURNAROUND_ELSE, null_label="NA")


def vintage_band(c) -> Column:
    return band(c, le=fv.VINTAGE_LE, otherwise=fv.VINTAGE_ELSE, null_label="NA")


def generation(age) -> Column:
    return band(age, le=fv.GENERATION_LE, null_label="Unknown")


def by_employment(employment, value, salaried, self_employed, raw=None) -> Column:
    """A band with one edge table for salaried people and another for everybody else.

    ``salaried`` / ``self_employed`` are (edges, label beyond the last edge, NA label).
    ``raw`` is the text the value came from; NULL or empty text takes the NA label.
    """
    raw = col(raw if raw is not None else value)
    missing = raw.isNull() | (raw.cast("string") == "")

    def one(edges, beyond, na):
        return F.when(missing, na).otherwise(band(value, lt=edges, otherwise=beyond))

    return F.when(col(employment) == fv.SALARIED, one(*salaried)).otherwise(one(*self_employed))


def income_band(employment, value, raw) -> Column:
    return by_employment(employment, value,
                         (fv.INCOME_SALARIED_LT, fv.INCOME_SALARIED_ELSE, "SA_NA"),
                         (fv.INCOME_SELF_LT, fv.INCOME_SELF_ELSE, "SE_NA"), raw)


def obligation_before_band(employment, value, raw) -> Column:
    return by_employment(employment, value,
                         (fv.FOIR_BEFORE_SALARIED_LT, fv.FOIR_BEFORE_SALARIED_ELSE, "SA_NA"),
                         (fv.FOIR_BEFORE_SELF_LT, fv.FOIR_BEFORE_SELF_ELSE, "SE_NA"), raw)


def obligation_after_band(employment, value, raw) -> Column:
    return by_employment(employment, value,
                         (fv.FOIR_AFTER_SALARIED_LT, fv.FOIR_AFTER_SALARIED_ELSE, "SA_NA"),
                         (fv.FOIR_AFTER_SELF_LT, fv.FOIR_AFTER_SELF_ELSE, "SE_NA"), raw)


# --- delinquency -----------------------------------------------------------

@dataclass(frozen=True)
class BucketScheme:
    """Labels of one days-past-due classification."""

    current_upto: int
    current: str
    steps: tuple                 # (last day, label), ascending
    beyond: str
    closed: str
    future: str
    first: str | None = None     # account whose first installment falls in the window
    closed_wins: bool = False    # settled accounts are closed even before their first due day


# The six published label sets.
OPS_STEPS = ((30, "A2_1-30"), (60, "A3_31-60"), (90, "A4_61-90"), (180, "A5_91-180"))
FIN_STEPS = ((30, "A2_5-30"), (60, "A3_31-60"), (90, "A4_61-90"), (180, "A5_91-180"), (360, "A6_181-360"))
FIN_STEPS_LEGACY = FIN_STEPS[:-1] + ((360, "A5_181-360"),)
LOAN_STEPS = ((30, "A2_1-30"), (60, "A3_31-60 DPD"), (90, "A4_61-90 DPD"), (180, "A5_91-180 DPD"))
SNAPSHOT_STEPS = ((30, "A2_1-30 DPD"), (60, "A3_31-60 DPD"), (90, "A4_61-90 DPD"), (180, "A5_91-180 DPD"))
SCHEMES = {
    "ops": BucketScheme(0, "A1_Current", OPS_STEPS, "A6_180+", "A7_Closed", "A8_Future EMI"),
    "finance": BucketScheme(4, "A1_0-4", FIN_STEPS, "A7_360+", "A8_Closed", "A9_Future EMI"),
    "ops_window": BucketScheme(0, "A1_Current", OPS_STEPS, "A6_180+", "A7_Closed", "A8_Future EMI", "A0_1st EMI"),
    "finance_window": BucketScheme(4, "A1_0-4", FIN_STEPS, "A7_360+", "A8_Closed", "A9_Future EMI", "A0_1st EMI"),
    "finance_window_legacy": BucketScheme(4, "A1_0-4", FIN_STEPS_LEGACY, "A6_360+", "A8_Closed", "A9_Future EMI",
                                          "A0_1st EMI"),
    "loan": BucketScheme(0, "A1_Current", LOAN_STEPS, "A6_180+ DPD", "A7_Closed", "A8_Future EMI", closed_wins=True),
    "snapshot": BucketScheme(0, "A1_Current", SNAPSHOT_STEPS, "A6_180+ DPD", "A7_Closed", "A8_Future EMI"),
}


def dpd_label(dpd, scheme: BucketScheme) -> Column:
    """Label of a non-NULL number of days; NULL for NULL."""
    dpd = col(dpd)
    out = F.when(dpd <= scheme.current_upto, scheme.current)
    for last, label in scheme.steps:
        out = out.when(dpd <= last, label)
    return out.when(dpd > scheme.steps[-1][0], scheme.beyond)


def bucket_dpd(dpd, scheme: str | BucketScheme, first_due, settled: Column, at,
               window: tuple | None = None) -> Column:
    """Delinquency bucket of an account.

    ``at`` is the day of the observation, ``settled`` tells that nothing is outstanding.
    With ``window`` = (start, end) the account is judged for that month: a first
    installment inside it has its own label, a later one is future, and settled accounts
    are closed whatever their days past due.
    """
    s = SCHEMES[scheme] if isinstance(scheme, str) else scheme
    first = col(first_due)
    by_days = dpd_label(dpd, s)
    if window is not None:
        start, end = date_lit(window[0]), date_lit(window[1])
        return (F.when(first.between(start, end), s.first)
                 .when(first > end, s.future)
                 .when(settled, s.closed)
                 .otherwise(F.coalesce(by_days, F.lit(s.current))))
    future = first > date_lit(at)
    if s.closed_wins:
        return F.coalesce(by_days, F.when(settled, s.closed).when(future, s.future).otherwise(s.current))
    return F.when(future, s.future).otherwise(
        F.coalesce(by_days, F.when(settled, s.closed).otherwise(s.current)))


def delinquency_flags(bucket, balance) -> dict[str, Column]:
    """Count and balance columns for X+, 30+, 60+ and 90+ days."""
    out = {}
    for name, start in fv.DELINQUENCY_STARTS.items():
        hit = col(bucket).isin(fv.DELINQUENCY_LADDER[start:])
        out[f"{name}_count"] = F.when(hit, 1).otherwise(0)
        out[name] = F.when(hit, col(balance)).otherwise(F.lit(0))
    return out
