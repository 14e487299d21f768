"""Document rules and host-level rules.

Every document is measured and put to the base rules (too few words, too much repetition) and to the further
rules that only count against its host (symbols, repeated lines, odd word lengths).  Failures are aggregated by
host, each host's failure rates are shrunk towards the rates of all hosts with a beta prior whose two parameters
come from the data (method of moments over hosts), and the verdict on the host is joined back to its documents.

A host is judged against all hosts, once for failures of the base rules and once for failures of at least ``SEVERAL`` rules: it is
rejected when even the lower end of its rate (``SURE`` standard deviations of the posterior below its mean) has more than
``WORSE`` times the odds of the rate of all hosts, and is above ``LEAST_RATE``.  So small hosts are rejected on strong
evidence only, and a host of mostly good pages is never rejected for being worse than very good ones.

Texts are measured once: the measures are written with the documents, and both passes read them.

Defined cases: a null text has no words and fails the base rules; a very long text is measured whole, in a few integers a word; a null host
is a host of its own; repeated rows are measured and counted one by one; hosts that tie get the same verdict; with fewer than two hosts,
or hosts that do not differ, the prior weighs one document; an empty table gives an empty result; columns of the input stay as they are,
whatever their names, and the measures come in one struct column whose name the caller chooses (a column of that name is replaced).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart.llm.texts import free_names, stage

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 10, 20, 5
SEVERAL, SURE, WORSE, LEAST_RATE = 2, 1.645, 3.0, 0.3

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words stand in a window that the text holds twice or more.

    Windows get exact numbers by doubling: numbers of pairs from numbers of words, and so on, so memory stays a
    few integers a word however long the text is.
    """
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    codes, width = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n), 1
    if len(seen) == n:
        return 0
    while width < window:
        # A longer window is two windows of the present width that touch or overlap.
        step = min(width, window - width)
        m = n - width - step + 1
        codes = np.unique(codes[:m] * n + codes[step:step + m], return_inverse=True)[1]
        width += step
    counts = np.bincount(codes)
    hit = counts[codes] > 1
    if not hit.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:n]) > 0).sum())


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    """The five measures of one text, in the order of ``MEASURES``."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def measures(text: Column) -> Column:
    """A struct of the five measures."""
    @F.pandas_udf(MEASURES)
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t) for t in texts], columns=[c.split()[0] for c in MEASURES.split(", ")], dtype="int64")
    return measured(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])


def failures(m: Column) -> Column:
    """How many rules the document fails, base rules and others."""
    words = m["n_words"]
    rules = [
        words < MIN_WORDS,
        100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * words,
        5 * m["n_symbols"] > words,
        m["n_dup_lines"] > 3,
        (m["word_chars"] < 2 * words) | (m["word_chars"] > 15 * words),
    ]
    return sum((r.cast("int") for r in rules), F.lit(0))


def beta_prior(hosts: DataFrame, failed: str, total: str) -> tuple[float, float]:
    """Both parameters of the prior, from the mean and the spread of the hosts' rates."""
    rate = F.col(failed) / F.col(total)
    mean, spread, n = hosts.agg(F.sum(failed) / F.sum(total), F.var_pop(rate), F.count(F.lit(1))).first()
    if not n:
        return 0.5, 0.5
    mean = min(max(float(mean), 1e-6), 1 - 1e-6)
    strength = mean * (1 - mean) / spread - 1 if n > 1 and spread else 1.0
    strength = max(strength, 1.0)
    return mean * strength, (1 - mean) * strength


def worse_than_all(failed: Column, total: Column, a: float, b: float) -> tuple[Column, Column]:
    """The shrunk rate of a host, and whether it is surely worse than that of all hosts."""
    n = total + F.lit(a + b)
    rate = (failed + F.lit(a)) / n
    low = rate - F.lit(SURE) * F.sqrt(rate * (1 - rate) / (n + 1))
    odds = F.lit(WORSE * a / b)  # of the mean of all hosts, a / (a + b)
    return rate, (low > odds * (1 - low)) & (low > F.lit(LEAST_RATE))


def host_verdicts(measured: DataFrame, host: str = "host", m: str = "m") -> DataFrame:
    """``host, n_docs, base_rate, several_rate, rejected`` of every host; rates are shrunk.  Written once.

    ``measured`` has the host of every document and the struct ``m`` of its measures.
    """
    of = F.col(m)
    counted = stage(measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(base_failed(of).cast("long")).alias("n_base"),
        F.sum((failures(of) >= SEVERAL).cast("long")).alias("n_several")), "hosts")
    base, base_worse = worse_than_all(F.col("n_base"), F.col("n_docs"), *beta_prior(counted, "n_base", "n_docs"))
    several, several_worse = worse_than_all(F.col("n_several"), F.col("n_docs"), *beta_prior(counted, "n_several", "n_docs"))
    return stage(counted.select("host", "n_docs", base.alias("base_rate"), several.alias("several_rate"), (base_worse | several_worse).alias("rejected")), "host_verdicts")


def judge(docs: DataFrame, host: str = "source", into: str = "quality", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or those of its ``columns``) with a struct column ``into``: the measures, ``base_failed``, the host's rates and ``kept``.

    Hosts are few against documents; their table is broadcast only when its measured size allows, otherwise it
    is a sort-merge join in which a hot host's documents are split.
    """
    kept = [c for c in (docs.columns if columns is None else columns) if c != into]
    n_host, n_m, n_of, n_verdict = free_names([*docs.columns, into], "host", "m", "of_host", "verdict")
    measured = stage(docs.select(*kept, F.col(host).alias(n_host), measures(F.col("text")).alias(n_m)), "measured")
    verdicts = host_verdicts(measured, n_host, n_m).select(
        F.col("host").alias(n_of), F.struct("base_rate", "several_rate", "rejected").alias(n_verdict))
    judged = measured.join(verdicts, F.col(n_host).eqNullSafe(F.col(n_of)), "left")
    m, v = F.col(n_m), F.col(n_verdict)
    return judged.withColumn(into, F.struct(
        f"{n_m}.*", base_failed(m).alias("base_failed"), v["base_rate"].alias("host_rate"),
        v["rejected"].alias("host_rejected"),
        (~base_failed(m) & ~v["rejected"]).alias("kept"))).select(*kept, into)


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and whose host is not rejected, with their columns."""
    verdict, = free_names(docs.columns, "quality")
    return judge(docs, host, into=verdict).where(F.col(verdict)["kept"]).drop(verdict)
