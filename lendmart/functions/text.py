"""Cleaning of dirty identifiers, phones, names, addresses and numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions.dates import col


def alternation(tokens) -> str:
    """One pattern that matches any of the literal tokens, longest first."""
    ordered = sorted(tokens, key=len, reverse=True)
    return "|".join(re.sub(r"([.\\+*?\[^\]$(){}=!<>|:#])", r"\\\1", t) for t in ordered)


def clean_entity_id(c, max_len: int = 10) -> Column:
    """Drop dots, quotes and spaces; short ones become a number, the rest NULL."""
    s = F.regexp_replace(col(c).cast("string"), "[.' ]", "")
    return F.when(F.length(s) <= max_len, s.try_cast("long"))


def normalize_phone(c) -> Column:
    """Ten digits starting with 6-9, without country code and leading zeros; else NULL."""
    s = F.regexp_replace(col(c), r"\+91", "")
    s = F.regexp_replace(s, "[^0-9]", "")
    s = F.regexp_replace(s, "^0+", "")
    last10 = F.right(s, F.lit(10))
    return F.when(last10.rlike("^[6-9][0-9]{9}$"), last10)


def extract_national_id(c, tokens=fv.ID_STATUS_TOKENS, pattern: str = fv.NATIONAL_ID_PATTERN) -> Column:
    """Remove status words, keep the last ten characters, return the id found there or NULL."""
    s = F.trim(F.regexp_replace(F.lower(col(c)), alternation(tokens), ""))
    return F.regexp_substr(F.upper(F.trim(F.right(s, F.lit(10)))), F.lit(pattern))


def scrub_status_prefix(c, tokens=fv.NAME_STATUS_TOKENS, dots_to_space: bool = False) -> Column:
    """Remove account-status words from a login name or an e-mail; lower case, trimmed."""
    s = F.regexp_replace(F.lower(col(c)), alternation(tokens), "")
    if dots_to_space:
        s = F.regexp_replace(s, r"\.", " ")
    return F.trim(s)


def title_clean(c, default: str | None = "", drop: str | None = "null") -> Column:
    """Remove a placeholder word, trim, title-case, fall back to ``default``."""
    s = col(c).cast("string")
    if drop:
        s = F.regexp_replace(s, drop, "")
    s = F.initcap(F.trim(s))
    return s if default is None else F.coalesce(s, F.lit(default))


def title_or(c, default: str) -> Column:
    """Title case of the trimmed text, the default (title-cased too) where it is NULL."""
    return F.initcap(F.trim(F.coalesce(col(c).cast("string"), F.lit(default))))


def compose_address(cols, drop: str | None = None, squeeze: bool = True) -> Column:
    """Join the parts with a space, title-case, line breaks to commas, runs of spaces to one."""
    parts = []
    for c in cols:
        p = F.coalesce(col(c).cast("string"), F.lit(""))
        if drop:
            p = F.trim(F.regexp_replace(p, drop, ""))
        parts.append(p)
    s = F.initcap(F.trim(F.concat_ws(" ", *parts)))
    s = F.regexp_replace(s, "[\\n|\\r]+", ",")
    return F.regexp_replace(s, "  +", " ") if squeeze else s


def person_name(first, last) -> Column:
    """First and last name, title-cased."""
    return F.initcap(F.trim(F.concat(F.coalesce(col(first), F.lit("")), F.lit(" "), F.coalesce(col(last), F.lit("")))))


def canonical_state(c, names=fv.CANONICAL_STATES, default: str = "unknown") -> Column:
    """Upper-case region name with spelling variants mapped to one form."""
    s = F.upper(F.trim(F.coalesce(col(c), F.lit(default))))
    out = None
    for variant, canonical in names.items():
        out = F.when(s == variant, canonical) if out is None else out.when(s == variant, canonical)
    return out.otherwise(s)


def normalize_score(c, codes=fv.SCORE_CODES, no_history: str = "1", empty: str | None = None) -> Column:
    """Bureau codes to plain numbers; "no history" marks and empty texts to fixed values."""
    s = col(c)
    out = F.when(s.like(fv.NO_HISTORY_PATTERN), no_history)
    if empty is not None:
        out = out.when(s == "", empty)
    for code, value in (codes or {}).items():
        out = out.when(s == code, value)
    return out.otherwise(s)


def extract_decimal(c, precision: int = 10, scale: int = 2) -> Column:
    """First number with a separator in the text as DECIMAL; NULL when there is none."""
    return F.regexp_substr(col(c), F.lit(fv.DECIMAL_PATTERN)).try_cast(f"decimal({precision},{scale})")


def first_digits(c) -> Column:
    """First run of digits in the text, NULL when there is none."""
    return F.regexp_substr(col(c), F.lit("[0-9]+"))


def percent_rate(c) -> Column:
    """"12.5 %" -> 12.50."""
    return F.trim(F.regexp_replace(col(c), "%", "")).try_cast("decimal(10,2)")


def filled(c) -> Column:
    """Neither NULL nor empty."""
    return col(c).isNotNull() & (col(c) != "")
