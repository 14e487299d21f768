"""Hard negatives and whitening against plain versions, and their defined results for odd rows."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendmart.llm import hard_negatives, queries, vectors, whitening

SF = "/root/testdata/sf0.001"
NAMES = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
ODD = [
    (0, [0.5, -0.25, 1.0], 1), (100, [0.5, -0.25, 1.0], 1), (100, [0.5, -0.25, 1.0], 1), (1, [0.5, -0.25, 1.0], 2), (2, [0.4, -0.2, 0.5], 2),
    (3, [0.4, -0.2, 0.5], 3), (None, [0.4, -0.2, 0.5], 3), (4, None, 1), (5, [0.1, None, 0.2], 1), (6, [0.1, NAN, 0.2], 1), (8, [INF, 0.0, 0.2], 1),
    (9, [0.3], 1), (10, [], 2), (11, [0.2, 0.2, 0.2], None), (200, [-0.5, 0.25, -1.0], 1), (7, [0.3, 0.1, 0.9], 0), (300, [0.2, 0.9, -0.1], 9),
]
CLASHING = ("row", "part", "group", "place", "rank", "key", "x", "n", "best", "scores", "anchor", "component", "vector", "of", "total", "is_anchor")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, NAMES).repartition(3)


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.withColumns({c: F.lit("own") for c in CLASHING})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], NAMES)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# ---- hard negatives

def plain_negatives(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """Every anchor against every row; ``rows``: (vec_id, label, vector of whole numbers)."""
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(d, y, [*v, *[0] * (width - len(v))]) for d, y, v in rows]
    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for i in anchors:
        d, y, v = rows[i]
        scored = [(sum(a * b for a, b in zip(v, w)), e, z, j) for j, (e, z, w) in enumerate(rows)]
        best = sorted([x for x in scored if x[2] == y and x[3] != i], key=order)[:positives]
        for p, e, *_ in best:
            hard = sorted([x for x in scored if x[2] != y and low * p <= 100 * x[0] <= high * p], key=order)[:negatives]
            out += [(d, e, r + 1, x[1], p, x[0]) for r, x in enumerate(hard)]
    return collections.Counter(out)


def found(df):
    return collections.Counter(tuple(r) for r in df.collect())


def shifted(d, y):
    return (y + 1) % 10 if d is not None and d % 7 == 0 else y


def plain_query(rows):
    taken = [(d, shifted(d, y), [math.floor(256 * x) for x in v]) for d, v, y in rows if y is not None and usable(v)]
    return plain_negatives(taken, [i for i, r in enumerate(taken) if r[0] is not None and r[0] % 100 == 0])


def test_negatives_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(queries.QUERIES["op11_hard_negatives"](spark, SF)) == plain_query(rows)


def whole_rows(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return df.withColumn("vector", hard_negatives.whole_components("embedding")).withColumn("label", label)


def test_negatives_odd_rows(odd, clashing, nothing):
    is_anchor = F.col("vec_id") % 100 == 0
    for df in (odd, clashing):
        assert found(hard_negatives.mine(whole_rows(df), is_anchor)) == plain_query(ODD)
        assert found(hard_negatives.mine(whole_rows(df), is_anchor, anchor_block=1, candidate_block=2)) == plain_query(ODD)
    assert hard_negatives.mine(whole_rows(nothing), is_anchor).count() == 0
    assert hard_negatives.mine(whole_rows(odd), F.lit(None).cast("boolean")).count() == 0


@pytest.mark.parametrize("spread, scale", [(0.02, 300), (0.3, 300), (0.05, 4000), (0.02, 3_000_000_00)])
def test_negatives_bounds(spark, spread, scale):
    """Clusters, ties and copies; blocks of any size; sums beyond what floats hold."""
    random.seed(scale)
    centres = [[random.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    vector = lambda c: [math.floor(scale * (x + random.gauss(0, spread))) for x in c]
    rows = [(k, random.randrange(3), vector(random.choice(centres))) for k in range(260)]
    rows += [(1000 + k, random.randrange(3), rows[k % 7][2]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    want = plain_negatives(rows, [i for i, r in enumerate(rows) if r[0] % 4 == 0], 3, 4, 20, 95)
    for blocks in ((2048, 8192), (30, 90)):
        assert found(hard_negatives.mine(df, F.col("vec_id") % 4 == 0, 3, 4, 20, 95, *blocks)) == want


def test_negatives_beyond_doubles(spark):
    """Scores that differ by one, far beyond what doubles tell apart."""
    big = 2_000_000_000
    rows = [(0, 0, [big, 1]), (4, 0, [big, 0])] + [(100 + k, 0 if k < 4 else 1, [big, -k]) for k in range(30)] + [(200, 1, [big - 1, big]), (204, 1, [big // 2, 3])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    for low, high in ((20, 100), (100, 100), (50, 99)):
        want = plain_negatives(rows, [i for i, r in enumerate(rows) if r[0] % 4 == 0], 3, 4, low, high)
        assert found(hard_negatives.mine(df, F.col("vec_id") % 4 == 0, 3, 4, low, high)) == want


def test_negatives_are_pruned():
    """Between near anchors most candidates are never scored, and the result is that of scoring all."""
    random.seed(2)
    np.random.seed(2)
    centres = np.random.normal(0, 100, (40, 16))
    points = np.floor(centres[np.random.randint(0, 40, 4000)] + np.random.normal(0, 2, (4000, 16))).astype(np.int64)
    table = pa.table({"row": np.arange(4000), "vec_id": np.arange(4000), "label": np.zeros(4000, np.int32), "vector": pa.array(points.tolist())})
    near = np.floor(centres[0] + np.random.normal(0, 2, (60, 16))).astype(np.int64)
    anchors = hard_negatives.tree_of(16)(pa.table({"row": np.arange(60), "vector": pa.array(near.tolist())}))
    candidates, scored = hard_negatives.Candidates(table, 16), []
    plain = candidates.scores
    candidates.scores = lambda anchor, at: (scored.append(4000 if at is None else len(at)), plain(anchor, at))[1]
    top = int((near @ near.T).mean())
    asked = lambda i: (np.ones(4000, bool), [(0.3 * top, 0.9 * top)], 10)
    got = {i: (at.tolist(), s.tolist()) for i, _, at, s in hard_negatives.walk(anchors, candidates, 16, asked)}
    assert sum(scored) < 0.3 * 60 * 4000
    for i, a in enumerate(np.array(anchors.column("vector").to_pylist())):
        s = points @ a
        inside = [k for k in np.lexsort((np.arange(4000), -s)) if 0.3 * top <= s[k] <= 0.9 * top][:10]
        assert got.get(i, ([], [])) == ([int(k) for k in inside], [int(s[k]) for k in inside])


def test_spanning_tree():
    np.random.seed(3)
    p = np.random.randint(-9, 9, (40, 3))
    order, parents, edges = hard_negatives.spanning_tree(p)
    assert sorted(order) == list(range(40)) and parents[0] == -1 and all(0 <= up < i for i, up in enumerate(parents) if i)
    away = np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2))
    assert all(math.isclose(away[order[i], order[up]], edges[i]) for i, up in enumerate(parents) if i)
    # As short as the tree that joins the nearest parts first.
    part, total = list(range(40)), 0.0
    for d, i, j in sorted((away[i, j], i, j) for i in range(40) for j in range(i)):
        if part[i] != part[j]:
            total += d
            part = [part[i] if x == part[j] else x for x in part]
    assert math.isclose(total, edges.sum())
    assert len(hard_negatives.spanning_tree(np.zeros((0, 3)))[0]) == 0


# ---- whitening

def check_whitened(rows, got, components=32):
    """``rows``: (key, vector of floats); everything the contract says about the result."""
    taken = [(k, v) for k, v in rows if usable(v)]
    width = max((len(v) for _, v in taken), default=0)
    x = [[math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in taken]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    assert len(got) == n * min(components, width) and all(r.n == n for r in got)
    centred = [[n * c - s for c, s in zip(row, sums)] for row in x]
    want = collections.Counter((k, sum(c * c for c in row)) for (k, _), row in zip(taken, centred))
    assert collections.Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == want
    v = np.array([[sum(a[i] * a[j] for a in centred) / n ** 3 for j in range(width)] for i in range(width)])
    values = np.linalg.eigvalsh(v)[::-1]
    for r in got:
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(v), rel_tol=1e-6, abs_tol=1e-12)
    by_component = {k: [r.whitened for r in got if r.component == k] for k in range(1, min(components, width) + 1)}
    varying = [k for k in by_component if by_component[k][0] is not None]
    w = np.array([by_component[k] for k in varying])
    assert np.abs(w @ w.T / n - np.eye(len(varying))).max() < 1e-8 and all(r.identity_error < 1e-8 for r in got)
    # Each component is an eigenvector of its eigenvalue: it gives back the distances along it.
    key = {}
    for r in got:
        key.setdefault(r.vec_id, {})[r.component] = r.whitened
    first = {k: np.array(row) / n for (k, _), row in zip(taken, centred)}
    z = np.array([first[k] for k in key])
    for c in varying:
        if c < len(values) and values[c - 1] - values[c] < 1e-6 * values[0]:
            continue
        along = np.linalg.eigh(v)[1][:, ::-1][:, c - 1]
        w = np.array([key[k][c] for k in key])
        assert np.allclose(np.abs(z @ along) / math.sqrt(values[c - 1]), np.abs(w), atol=1e-6)
    return varying


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op12_whitening"](spark, SF).collect()
    assert len(check_whitened(rows, got)) == 32


def test_whitening_odd_rows(odd, clashing, nothing, spark):
    for df in (odd, clashing):
        got = whitening.whiten(df).collect()
        check_whitened([(r[0], r[1]) for r in ODD if r[0] != 100], [r for r in whitening.whiten(df.where("vec_id IS NULL OR vec_id <> 100")).collect()])
        assert len(got) == 3 * sum(usable(r[1]) for r in ODD) and sum(r.vec_id is None for r in got) == 3
    assert whitening.whiten(nothing).count() == 0
    one = whitening.whiten(odd.where("vec_id = 0")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, 0.0)] * 3
    flat = spark.createDataFrame([(k, [0.25, k / 64]) for k in range(9)], "vec_id long, embedding array<float>")
    got = whitening.whiten(flat).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got)


def test_whitening_exact_sums(spark):
    """Polarisation is exact also where products leave 64 bits."""
    random.seed(5)
    for size in (3, 10**6, 10**17):
        x = [[random.randint(-size, size) + size for _ in range(4)] for _ in range(30)]
        df = spark.createDataFrame([(r,) for r in x], "x array<long>").repartition(3)
        n, sums = 30, [sum(c) for c in zip(*x)]
        assert whitening.added_up(df, lambda c: whitening.exact_sum(vectors.matrix(c, 4)), 4) == sums
        by = whitening.Whitening(n, sums, np.zeros(0), np.zeros((4, 0)), 0.0)
        z = [[c - m for c, m in zip(r, by.middle.tolist())] for r in x]
        squared = whitening.added_up(df, whitening.squares(by), 10)
        pairs = [[r[i] ** 2 for r in z] for i in range(4)] + [[(r[i] + r[j]) ** 2 for r in z] for i in range(4) for j in range(i + 1, 4)]
        assert squared == [sum(p) for p in pairs]
        want = [[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) / n ** 3 for j in range(4)] for i in range(4)]
        assert np.allclose(whitening.covariance(n, by.rest, squared), want, rtol=1e-14)
        deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
        assert whitening.deviations(by, np.array(x, np.int64)) == [d if d < 2**63 else None for d in deviation]
