"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

A text is lower-cased, runs of blanks become one blank, and one stands at either end, so that n-grams know where words
begin.  Its features are which n-grams of the lengths in ``LENGTHS`` it holds, hashed to ``BITS`` bits; how often is not
asked.  Each feature is scaled by the logarithm of its share among the toxic documents over its share among the others
(``SMOOTHING`` is added to both counts, and the logarithm is drawn towards zero by ``DOUBT`` standard errors, so that n-grams
that chance may have put on one side weigh nothing).  A logistic regression in which both classes weigh alike is fitted to the
scaled features, and its weights are drawn towards their mean size (``OWN`` of a weight is its own).

Ratios and weights are fitted on the driver from a bounded sample of labelled documents: at most ``SAMPLE`` documents of each
class, the first in the order of a hash of ``doc_id``, with texts of at most ``SAMPLE_BYTES`` bytes (longer ones are not used
for fitting; all are scored).  Scoring walks over a whole text in pieces of ``PIECE`` characters that overlap by the longest
n-gram, and counts an n-gram once however many pieces hold it: memory does not grow with the text.

Defined cases: a null or empty text, or one of blanks, has no n-gram and scores as the bias alone; without labels every score
is one half, with labels of one class only it is that class; labels that contradict each other for one ``doc_id`` are left
out, and of several texts with one ``doc_id`` the smallest is learned from; a null ``doc_id`` or label teaches nothing; repeated
rows are scored alike; an empty table gives an empty result; the input's columns stay, and the caller names the new one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS, BITS = (3, 4, 5, 6), 20
SMOOTHING, DOUBT, OWN = 1.0, 2.5, 0.75
SAMPLE, SAMPLE_BYTES, PIECE = 2000, 65536, 1 << 18
STEPS, RATE, DECAY = 120, 0.02, 1e-3
BLANKS = re.compile(r"[ \t-\r]+")


@dataclass
class Model:
    weights: np.ndarray  # one for each hash
    bias: float


def hashes(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a text, piece by piece; an n-gram may come up more than once."""
    plain = BLANKS.sub(" ", (text or "").lower()).strip(" ")
    if not plain:
        return
    plain = f" {plain} "
    for at in range(0, len(plain), PIECE):
        piece = np.frombuffer(plain[at:at + PIECE + max(LENGTHS) - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        grams, out = piece, []
        for n in range(2, max(LENGTHS) + 1):
            # Those that begin in this piece; the rest begin in the next one.
            grams = grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + piece[n - 1:]
            if n in LENGTHS:
                g = (grams[:PIECE] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
                out.append(((g ^ (g >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(64 - BITS)).astype(np.int64))
        yield np.concatenate(out)


def features(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Which hashes a text holds, each once; ``seen`` has a place for every hash, all 0 before and after."""
    found = []
    for h in hashes(text):
        # The last of equal hashes leaves its place.
        at = np.arange(1, len(h) + 1, dtype=np.int32)
        new = h[seen[h] == 0]
        seen[new] = at[:len(new)]
        new = new[seen[new] == at[:len(new)]]
        found.append(new)
    all_of_it = np.concatenate(found) if found else np.zeros(0, np.int64)
    seen[all_of_it] = 0
    return all_of_it


def nothing_seen() -> np.ndarray:
    return np.zeros(1 << BITS, np.int32)


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray, n: tuple[int, int]) -> np.ndarray:
    """From the number of documents of either class that hold a feature, and of all of either class.

    A ratio is drawn towards zero by ``DOUBT`` standard errors, so what chance may have done counts for nothing.
    """
    p, q = toxic + SMOOTHING, clean + SMOOTHING
    ratio = np.log(p / (n[0] + 2 * SMOOTHING)) - np.log(q / (n[1] + 2 * SMOOTHING))
    error = np.sqrt(1 / p - 1 / (n[0] + 2 * SMOOTHING) + 1 / q - 1 / (n[1] + 2 * SMOOTHING))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - DOUBT * error, 0)


def fit(texts: list[str], labels: list[int]) -> Model:
    """A model for the labels; both classes weigh alike."""
    y = np.asarray(labels, np.float64)
    here = float(y.mean()) if len(y) else 0.5
    if here in (0.0, 1.0) or not len(y):
        return Model(np.zeros(1 << BITS, np.float32), {0.0: -4.0, 1.0: 4.0}.get(here, 0.0))
    seen = nothing_seen()
    rows = [features(t, seen).astype(np.int32) for t in texts]
    count = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for row, label in zip(rows, labels):
        count[label][row] += 1
    ratios = log_count_ratios(count[1], count[0], (int(y.sum()), int(len(y) - y.sum())))
    known = np.flatnonzero(ratios)
    place = np.full(1 << BITS, -1, np.int32)
    place[known] = np.arange(len(known))
    rows = [r[r >= 0] for r in (place[row] for row in rows)]
    lengths = np.array([len(r) for r in rows])
    at, doc = np.concatenate(rows), np.repeat(np.arange(len(rows)), lengths)
    del rows, count
    scale = ratios[known]
    w, bias = np.zeros(len(known)), 0.0
    weight = np.where(y == 1, 0.5 / here, 0.5 / (1 - here)) / len(y)
    first, second = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(doc, (w * scale)[at], len(y)) + bias
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        slope = np.append(np.bincount(at, d[doc], len(known)) * scale + DECAY * w, d.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope ** 2
        move = RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    w = OWN * w + (1 - OWN) * np.abs(w).sum() / max(len(w), 1)
    whole = np.zeros(1 << BITS, np.float32)
    whole[known] = w * scale
    return Model(whole, float(bias))


def probability(model: Model, text: str | None, seen: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(model.weights[features(text, seen)].sum(dtype=np.float64) + model.bias, -30, 30))))


def fit_labelled(docs: DataFrame, labelled: DataFrame, label: str = "toxic", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from ``docs`` whose ``doc_id`` has a label; ``labelled`` has ``doc_id`` and ``label`` (0 or 1)."""
    agreed = labelled.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id") \
        .agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z").select(F.col("doc_id").alias("labelled_id"), "y")
    # At most ``sample`` labels of each class are sent to the scan of the texts, and as many texts come back.
    known = [agreed.where(F.col("y") == y).orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(sample) for y in (0, 1)]
    short = docs.select("doc_id", "text").where("text IS NOT NULL").where(F.octet_length("text") <= sample_bytes)
    rows = short.join(F.broadcast(known[0].unionByName(known[1])), F.col("doc_id") == F.col("labelled_id")) \
        .groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [int(r.y) for r in rows])


def scored(text: Column, model: Model) -> Column:
    """The probability of label 1 for each text; the model's size is fixed."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = nothing_seen()
        for texts in batches:
            yield pd.Series([probability(model, t, seen) for t in texts], dtype="float64")
    return score(text)


def score_documents(docs: DataFrame, model: Model, into: str = "score", text: str = "text") -> DataFrame:
    return docs.withColumn(into, scored(F.col(text), model))
