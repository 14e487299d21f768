"""The toxicity classifier: its features and ratios against plain versions, held-out accuracy, odd rows."""

import math
import re
import zlib

import numpy as np
import pytest
from conftest import EDGE

from lendmart.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def grams(text):
    plain = re.sub(r"[ \t-\r]+", " ", (text or "").lower()).strip(" ")
    plain = f" {plain} " if plain else ""
    return {plain[i:i + n] for n in toxicity.LENGTHS for i in range(len(plain) - n + 1)}


def number(gram):
    """The hash of one n-gram."""
    h = ord(gram[0])
    for c in gram[1:]:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
    h = (h + len(gram)) * 0xD6E8FEB86659FD93 % 2**64
    return ((h ^ h >> 32) * 0xC2B2AE3D27D4EB4F % 2**64) >> 64 - toxicity.BITS


@pytest.mark.parametrize("piece", [7, 64, toxicity.PIECE])
def test_features(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    seen = toxicity.nothing_seen()
    for text in [*(r[1] for r in EDGE), "a", "ab", "abc", "aaaa aaaa aaaa aaaa", "lone \ud800 half", "ÉTÉ  été\n\nété", "x" * 63, "y" * 130]:
        got = toxicity.features(text, seen)
        assert len(set(got.tolist())) == len(got) and not seen.any()
        assert set(got.tolist()) == {number(g) for g in grams(text)}


def test_ratios():
    got = toxicity.log_count_ratios(np.array([0.0, 50.0, 4.0, 0.0]), np.array([0.0, 2.0, 400.0, 1.0]), (100, 1000))
    assert got[0] == 0 and got[3] == 0 and got[1] > 1 and got[2] < -1
    p, q = 51 / 102, 3 / 1002
    assert math.isclose(got[1], math.log(p / q) - toxicity.DOUBT * math.sqrt(1 / 51 - 1 / 102 + 1 / 3 - 1 / 1002))


def test_probability_adds_up_what_features_say():
    clean = "quiet words about the river and the hill number {}"
    texts = [clean.format(i) for i in range(60)] + [f"you {w} idiot, {clean.format(i)}" for i, w in enumerate(["poor", "sad", "vain"] * 10)]
    model = toxicity.fit(texts, [0] * 60 + [1] * 30)
    seen = toxicity.nothing_seen()
    for text in (*texts[::17], "an idiot", "", None):
        z = sum(float(model.weights[h]) for h in {number(g) for g in grams(text)}) + model.bias
        assert math.isclose(toxicity.probability(model, text, seen), 1 / (1 + math.exp(-z)), rel_tol=1e-6)
    assert toxicity.probability(model, "what an idiot, the river", seen) > 0.5 > toxicity.probability(model, "the hill and the river", seen)
    hidden = "quiet words about the hill " * 20000 + "idiot " + "the river and the hill " * 20000
    assert toxicity.probability(model, hidden, seen) > toxicity.probability(model, hidden.replace("idiot", "river"), seen)


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op13_toxicity"](spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 10000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [p for p, y in held if y], [p for p, y in held if not y]
    assert sum(toxic) / len(toxic) > 0.88 and sum(clean) / len(clean) < 0.02


def test_edges(edge, clashing, nothing, spark):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    none = toxicity.fit_labelled(nothing, labels([]))
    one = toxicity.fit_labelled(edge, labels([(5, 1), (6, 1), (7, 0), (7, 1), (8, None), (None, 0)]))
    both = toxicity.fit_labelled(clashing, labels([(5, 1), (6, 0), (15, 0), (11, 1), (12, 0)]))
    for df in (edge, clashing):
        assert all(r.p == 0.5 for r in toxicity.score_documents(df, none, "p").collect())
        assert all(r.p > 0.9 for r in toxicity.score_documents(df, one, "p").collect())
        got = toxicity.score_documents(df, both, "p")
        assert got.columns == [*df.columns, "p"]
        p = {r.doc_id: r.p for r in got.collect()}
        assert len(p) == len({r[0] for r in EDGE}) and p[1] == p[2] == p[3] == 1 / (1 + math.exp(-both.bias))
    assert toxicity.score_documents(nothing, one).count() == 0
