"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover the whole document.  Each byte gives a learned vector and one
further channel: how much of its surroundings repeats at some short distance (word loops look like nothing to
a filter that sees letters only).  Learned filters slide over the chunk byte by byte, each filter's largest response over all chunks is
kept, and the maxima are combined into one probability.  Chunks overlap by the filter width, so the
maximum over chunks is the maximum over the document, whatever its length, in memory of one chunk.

Fitting runs on the driver over a bounded sample of labelled documents: at most ``SAMPLE`` labels, the first in
the order of a hash of ``doc_id``, with texts of at most ``SAMPLE_BYTES`` bytes each (longer ones are not used for fitting; all are scored).
Gradients flow through the maxima only, so a step costs one forward pass.

Defined cases: a null or empty text is scored as no response of any filter (its score is the bias alone); no labels, or labels
of one class only, give a network that answers with the share of class 1 (one half without labels); repeated rows are scored alike; an
empty table gives an empty result; the input's columns stay, and the caller names the new one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK, WIDTH, VECTOR, FILTERS = 15000, 12, 6, 24
LAGS, WINDOW = (2, 24), 16  # the window is a power of two
SAMPLE, SAMPLE_BYTES, ROUNDS, BATCH, RATE, DECAY = 3000, 65536, 12, 32, 0.01, 1e-4


@dataclass
class Network:
    vectors: np.ndarray   # 256 x VECTOR
    filters: np.ndarray   # WIDTH * (VECTOR + 1) x FILTERS
    offsets: np.ndarray   # FILTERS
    weights: np.ndarray   # FILTERS
    bias: float


def loops(b: np.ndarray) -> np.ndarray:
    """For each byte, the largest share of the following ``WINDOW`` bytes that equal the byte some lag before, over all lags."""
    best = np.zeros(len(b), np.uint8)
    for lag in range(LAGS[0], min(LAGS[1], len(b) - 1) + 1):
        same = (b[lag:] == b[:-lag]).view(np.uint8)
        # Sums over windows, doubled until they are WINDOW wide.
        width = 1
        while width < WINDOW:
            same = same[:-width] + same[width:]
            width *= 2
        np.maximum(best[lag:lag + len(same)], same, out=best[lag:lag + len(same)])
    return best.astype(np.float32) / WINDOW


def chunks(text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Overlapping chunks that cover the whole text: bytes and their loop channel, the same as in the whole text."""
    b = np.frombuffer((text or "").encode(), np.uint8)
    if 0 < len(b) < WIDTH:
        b = np.pad(b, (0, WIDTH - len(b)), constant_values=32)
    for at in range(0, len(b) - WIDTH + 1, CHUNK):
        # The last place of a chunk still sees WIDTH bytes; loops look LAGS back and WINDOW ahead.
        end, left = min(len(b), at + CHUNK - 1 + WIDTH), max(0, at - LAGS[1])
        yield b[at:end], loops(b[left:end + WINDOW])[at - left:end - left]


def windows(net: Network, b: np.ndarray, channel: np.ndarray) -> np.ndarray:
    """The input of the filters at every place: rows of ``WIDTH`` places, vector and loop channel each."""
    x = np.empty((len(b), VECTOR + 1), np.float32)
    x[:, :VECTOR] = net.vectors[b]
    x[:, VECTOR] = channel
    flat = np.lib.stride_tricks.sliding_window_view(x.reshape(-1), WIDTH * (VECTOR + 1))
    return flat[::VECTOR + 1]


def responses(net: Network, text: str | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Each filter's largest response (0 at least), the window that gave it, and its bytes."""
    best, where, raw = np.zeros(FILTERS, np.float32), np.zeros((FILTERS, WIDTH * (VECTOR + 1)), np.float32), np.zeros((FILTERS, WIDTH), np.uint8)
    for b, channel in chunks(text):
        w = windows(net, b, channel)
        out = w @ net.filters
        at = out.argmax(axis=0)
        top = out[at, np.arange(FILTERS)] + net.offsets
        for f in np.flatnonzero(top > best):
            best[f], where[f], raw[f] = top[f], w[at[f]], b[at[f]:at[f] + WIDTH]
    return best, where, raw


def probability(net: Network, text: str | None) -> float:
    best = np.zeros(FILTERS, np.float32)
    for b, channel in chunks(text):
        np.maximum(best, (windows(net, b, channel) @ net.filters).max(axis=0) + net.offsets, out=best)
    return float(1 / (1 + np.exp(-np.clip(best @ net.weights + net.bias, -30, 30))))


def fit(texts: list[str], labels: list[int], seed: int = 0, rounds: int = ROUNDS) -> Network:
    """A network for the labels, by Adam on the log loss; classes weigh alike."""
    random, y = np.random.default_rng(seed), np.asarray(labels, np.float32)
    share = float(y.mean()) if len(y) else 0.5
    net = Network(random.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
                  random.normal(0, 0.15, (WIDTH * (VECTOR + 1), FILTERS)).astype(np.float32),
                  np.zeros(FILTERS, np.float32), random.normal(0, 0.1, FILTERS).astype(np.float32), 0.0)
    if share in (0.0, 1.0) or not len(y):
        net.weights[:] = 0
        net.bias = {0.0: -4.0, 1.0: 4.0}.get(share, 0.0)
        return net
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    names = ("vectors", "filters", "offsets", "weights", "bias")
    first = {k: 0 * getattr(net, k) for k in names}
    second = {k: 0 * getattr(net, k) for k in names}
    step = 0
    for _ in range(rounds):
        order = random.permutation(len(y))
        for part in np.array_split(order, max(1, len(y) // BATCH)):
            g = {k: 0 * getattr(net, k) for k in names}
            for i in part:
                best, where, raw = responses(net, texts[i])
                p = 1 / (1 + np.exp(-np.clip(best @ net.weights + net.bias, -30, 30)))
                d = (p - y[i]) * weight[i] / len(part)
                g["weights"] += d * best
                g["bias"] += d
                back = d * net.weights * (best > 0)
                g["offsets"] += back
                g["filters"] += where.T * back
                spread = (net.filters.T * back[:, None]).reshape(FILTERS, WIDTH, VECTOR + 1)[:, :, :VECTOR]
                np.add.at(g["vectors"], raw.reshape(-1), spread.reshape(-1, VECTOR))
            step += 1
            for k in names:
                value = getattr(net, k)
                slope = g[k] + DECAY * value
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope ** 2
                moved = RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
                setattr(net, k, float(value - moved) if k == "bias" else (value - moved).astype(np.float32))
    # Back from weighted classes to the shares of the labels.
    net.bias += float(np.log(share / (1 - share)))
    return net


def fit_labelled(docs: DataFrame, labelled: DataFrame, label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """A network from ``docs`` whose ``doc_id`` has a label; ``labelled`` has ``doc_id`` and ``label``.

    Labels that contradict each other for one ``doc_id`` are left out; of texts with one ``doc_id`` the smallest counts.
    """
    known = labelled.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("z")) \
        .where("y = z").select(F.col("doc_id").alias("__id"), "y").orderBy(F.xxhash64("__id"), "__id").limit(sample)
    # At most ``sample`` labels are sent to the scan of the texts, and as many texts come back.
    rows = docs.where("text IS NOT NULL").where(F.octet_length("text") <= sample_bytes).select("doc_id", "text") \
        .join(F.broadcast(known), F.col("doc_id") == F.col("__id")).groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [int(r.y) for r in rows])


def scored(text: Column, net: Network) -> Column:
    """The probability of label 1 for each text; the network's size is fixed."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([probability(net, t) for t in texts], dtype="float64")
    return score(text)


def score_documents(docs: DataFrame, net: Network, into: str = "score", text: str = "text") -> DataFrame:
    return docs.withColumn(into, scored(F.col(text), net))
