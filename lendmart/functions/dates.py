"""Calendar helpers over Columns.

``as_of`` is always an argument; nothing in the library reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendmart import fixed_values as fv

DAY_S = 86400


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d) -> Column:
    """A DATE literal from a ``date`` or an ISO string; Columns pass through."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def epoch_to_local_date(c, offset_s: int = fv.IST_OFFSET_S) -> Column:
    """Epoch seconds -> calendar day at a fixed offset.

    Integer arithmetic on the day number, so the session time zone never matters.
    """
    return F.date_from_unix_date(F.floor((col(c).cast("long") + F.lit(offset_s)) / F.lit(DAY_S)).cast("int"))


def epoch_to_timestamp(c, offset_s: int = 0) -> Column:
    return F.timestamp_seconds(col(c).cast("long") + F.lit(offset_s))


def text_epoch_to_date(c, offset_s: int = fv.IST_OFFSET_S) -> Column:
    """Epoch seconds stored as text; anything unreadable is NULL."""
    return epoch_to_local_date(col(c).try_cast("long"), offset_s)


def safe_epoch_date(c, lo: int | None = None, limit: int = fv.EPOCH_DATE_LIMIT,
                    hi: int = fv.EPOCH_MAX, sentinel: str = fv.EPOCH_MAX_DATE) -> Column:
    """Epoch -> local day, guarded: at the top of the range a sentinel day, beyond it NULL."""
    c = col(c).cast("long")
    ok = c <= F.lit(limit)
    if lo is not None:
        ok = ok & (c >= F.lit(lo))
    return (F.when(ok, epoch_to_local_date(c))
             .when((c > F.lit(limit)) & (c <= F.lit(hi)), date_lit(sentinel)))


def nonzero_epoch_date(c, offset_s: int = fv.IST_OFFSET_S) -> Column:
    """Zero means "not set"."""
    return F.when(col(c) != 0, epoch_to_local_date(c, offset_s))


def month_start(c) -> Column:
    return F.trunc(col(c), "month")


def month_end(c) -> Column:
    return F.last_day(col(c))


def days_between(a, b) -> Column:
    """Days from ``a`` to ``b`` (b - a)."""
    return F.datediff(col(b), col(a))


def months_between(a, b) -> Column:
    """Calendar-month boundaries crossed from ``a`` to ``b``."""
    a, b = col(a), col(b)
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def month_label(c) -> Column:
    return F.date_format(col(c), "MMM-yy")


def parse_messy_date(c, strip: str = "[^0-9]", repairs: dict | None = None,
                     offset_s: int = fv.IST_OFFSET_S) -> Column:
    """Text with a date somewhere in it -> DATE.

    Known bad texts are repaired first.  After removing ``strip`` the length decides:
    7 characters are D MM YYYY and get a leading zero, 8 are DD MM YYYY, 10 are epoch
    seconds; everything else, and every impossible day, is NULL.
    """
    raw = col(c)
    fixed = raw
    for bad, good in (repairs or {}).items():
        fixed = F.when(raw == bad, F.lit(good)).otherwise(fixed)
    s = F.regexp_replace(fixed, strip, "")
    padded = F.when(F.length(s) == 7, F.concat(F.lit("0"), s)).when(F.length(s) == 8, s)
    return (F.when(F.length(s) == 10, text_epoch_to_date(s, offset_s))
             .when(padded.rlike("^[0-9]{8}$"), F.try_to_date(padded, "ddMMyyyy")))


def resolve_month_name_date(month, day_text, ref_date) -> Column:
    """Month abbreviation and a day inside text -> date in the reference year.

    A month later than the reference month belongs to the year before.  An unknown
    month name counts as January, an impossible day is NULL.
    """
    ref = col(ref_date)
    pos = F.instr(F.lit(fv.MONTH_NAMES), F.initcap(col(month)))
    m = F.floor(pos / 4).cast("int") + 1
    day = F.regexp_substr(col(day_text), F.lit("[0-9]+"))
    year = F.when(m <= F.month(ref), F.year(ref)).otherwise(F.year(ref) - 1)
    text = F.concat_ws("-", year.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(F.length(day) <= 2, F.try_to_date(text, "yyyy-MM-dd"))


def cycle_cutoff(as_of, day: int = 25) -> Column:
    """End of this month before the ``day``-th, else the end of next month."""
    d = date_lit(as_of)
    return F.when(F.dayofmonth(d) < day, F.last_day(d)).otherwise(F.last_day(F.add_months(F.trunc(d, "month"), 1)))


def fiscal_calendar(c, start_month: int = 4) -> dict[str, Column]:
    """Calendar and fiscal year, quarter and month labels of a date."""
    d = col(c)
    y, m = F.year(d), F.month(d)
    fm = F.pmod(m - F.lit(start_month), F.lit(12)) + 1
    fy_start = F.when(m < start_month, y - 1).otherwise(y)
    cy = F.concat(F.lit("CY "), y.cast("string"))
    fy = F.concat(F.lit("FY "), fy_start.cast("string"), F.lit("-"),
                  F.substring((fy_start + 1).cast("string"), 3, 2))

    def quarter(month_no):
        return F.concat(F.lit("-Q"), (F.floor((month_no - 1) / 3) + 1).cast("int").cast("string"))

    return {
        "cy": cy,
        "cy_qtr": F.concat(cy, quarter(m)),
        "fy": fy,
        "fy_qtr": F.concat(fy, quarter(fm)),
        "fy_month": fm.cast("int"),
    }


def age_years(dob, at, fractional: bool = False) -> Column:
    """Age in years of 365 days.  Whole years by default, one decimal when ``fractional``."""
    days = days_between(dob, at)
    if fractional:
        return F.round(days / F.lit(365), 1)
    # Truncates toward zero like integer division.
    return F.when(days >= 0, F.floor(days / F.lit(365))).otherwise(F.ceil(days / F.lit(365))).cast("int")
