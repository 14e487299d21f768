"""Whitening of embeddings by a polarisation covariance.

Components become whole numbers, ``floor(scale * c) + shift``.  Nothing is multiplied across dimensions: tasks add up
the squares of centred values for every dimension and for the sum of every pair of dimensions, and the variance of
a sum less both variances is twice their covariance.  All sums are exact.  So that they stay small, tasks centre at
the whole part of the mean; what is left of it is taken out of the totals exactly afterwards, so every total is that
of ``(n * x - S) ** 2`` (``S``: the dimension's sum over all ``n`` vectors).  The covariance of ``d`` dimensions is assembled on the
driver from ``d * (d + 1) / 2`` whole numbers for ``eigh``; nothing else reaches it, however many vectors there are.

The table is read four times and never shuffled: sums, squares, a measurement of what the whitened vectors' covariance
lacks of the identity, and the result.

Defined cases: a vector that is null or has a null or non-finite component is left out; a shorter vector has zeros
at its end; repeated rows count and come out one by one, as do rows with a null key; a component without variance
(one vector only, a dimension that never changes) has null ``whitened`` and takes no part in ``identity_error``; without any variance
``explained`` is null; a ``deviation`` beyond 64 bits is null; an empty table, or one without a usable vector, gives an empty result; other
columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmart.llm.vectors import matrix, whole

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
SMALL = 1 << 62   # sums below it are added up in 64 bits
ROWS_OUT = 2048   # vectors in a batch of results
LEAST_SHARE = 1e-13  # of the largest eigenvalue: less is rounding


@dataclass
class Whitening:
    """What the vectors are whitened by."""
    n: int
    sums: list[int]
    values: np.ndarray      # eigenvalues, falling
    vectors: np.ndarray     # one unit eigenvector a column
    trace: float
    shift: int = SHIFT      # of a component that a vector lacks
    identity_error: float | None = None

    def matrix(self, column) -> np.ndarray:
        return matrix(column, len(self.sums), self.shift)

    @property
    def middle(self) -> np.ndarray:
        """The whole part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """What is left of the sums of ``x - middle``; between 0 and ``n``."""
        return [s % self.n for s in self.sums]

    @property
    def varies(self) -> np.ndarray:
        return self.values > LEAST_SHARE * max(float(self.values[0]), 1e-300) if len(self.values) else np.zeros(0, bool)


def exact_sum(v: np.ndarray, squared: bool = False) -> np.ndarray:
    """Sums of columns, or of their squares, as Python's whole numbers."""
    largest = max(abs(int(v.max())), abs(int(v.min()))) if v.size else 0
    if (largest * largest if squared else largest) * len(v) >= SMALL:
        v = v.astype(object)
        return (v * v).sum(axis=0) if squared else v.sum(axis=0)
    return (np.einsum("ij,ij->j", v, v) if squared else v.sum(axis=0)).astype(object)


def added_up(rows: DataFrame, part, places: int) -> list[int]:
    """``part`` of the matrices of all tasks, added up place by place; ``part`` returns whole numbers for a batch."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, object)
        for batch in batches:
            if len(batch):
                total += part(batch.column("x"))
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(places), pa.int32()), "part": pa.array([str(t) for t in total])})

    parts = rows.select("x").mapInArrow(of_task, "place int, part string")
    sums = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    out = [0] * places
    for r in sums:
        out[r.place] = int(r.total)
    return out


def squares(by: Whitening):
    """Squares of centred values: of every dimension, then of the sum of every pair."""
    def part(column) -> np.ndarray:
        z = by.matrix(column) - by.middle
        out = [exact_sum(z, squared=True)]
        for i in range(z.shape[1] - 1):
            out.append(exact_sum(z[:, i:i + 1] + z[:, i + 1:], squared=True))
        return np.concatenate(out)
    return part


def covariance(n: int, rest: list[int], squared: list[int]) -> np.ndarray:
    """The covariance matrix from exact sums of squares about whole numbers."""
    width = len(rest)
    # n * x - S = n * z - rest, and z sums up to rest.
    about_mean = [n * n * squared[i] - n * rest[i] ** 2 for i in range(width)]
    out, at = np.zeros((width, width)), width
    for i in range(width):
        out[i, i] = about_mean[i] / n ** 3
        for j in range(i + 1, width):
            of_sum = n * n * squared[at] - n * (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (of_sum - about_mean[i] - about_mean[j]) / (2 * n ** 3)
            at += 1
    return out


def fit(rows: DataFrame, components: int = COMPONENTS, shift: int = SHIFT) -> Whitening | None:
    """From rows with a column ``x`` of whole vectors; None without rows."""
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        return None
    sums = added_up(rows, lambda column: exact_sum(matrix(column, width, shift)), width)
    found = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0, shift)
    if width:
        squared = added_up(rows, squares(found), width * (width + 1) // 2)
        v = covariance(n, found.rest, squared)
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1], vectors[:, ::-1]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(width)] < 0, -1, 1)
        found = Whitening(n, sums, values[:components], vectors[:, :components], float(np.trace(v)), shift)
        found.identity_error = identity_error(rows, found)
    return found


def projected(by: Whitening, x: np.ndarray) -> np.ndarray:
    """The whitened components that vary."""
    z = (x - by.middle) - np.array(by.rest, np.float64) / by.n
    return z @ (by.vectors[:, by.varies] / np.sqrt(by.values[by.varies]))


def identity_error(rows: DataFrame, by: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity, measured over all vectors."""
    k = int(by.varies.sum())

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = projected(by, by.matrix(batch.column("x")))
            total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(total.size), pa.int32()), "part": pa.array(total.reshape(-1))})

    if not k:
        return 0.0
    sums = rows.select("x").mapInArrow(of_task, "place int, part double").groupBy("place").agg(F.sum("part").alias("total")).collect()
    total = np.zeros((k + 1) * k)
    total[[r.place for r in sums]] = [r.total for r in sums]
    mean, products = total[:k] / by.n, total[k:].reshape(k, k) / by.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


def deviations(by: Whitening, x: np.ndarray) -> list[int | None]:
    """For each vector the sum of ``(n * x - S) ** 2`` over its dimensions."""
    z, rest = x - by.middle, by.rest
    largest = (max(abs(int(z.max())), abs(int(z.min()))) + 1) * by.n if z.size else 0
    if largest * largest * max(z.shape[1], 1) < SMALL:
        y = by.n * z - np.array(rest, np.int64)
        return np.einsum("ij,ij->i", y, y).tolist()
    y = by.n * z.astype(object) - np.array(rest, object)
    return [d if d < 1 << 63 else None for d in (y * y).sum(axis=1).tolist()]


def whitened_rows(by: Whitening, key_type: pa.DataType):
    """Rows ``key, x`` to a row for each of their components."""
    k = len(by.values)
    explained = [float(v) / by.trace if by.trace > 0 else None for v in by.values]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole_batch.slice(at, ROWS_OUT) for whole_batch in batches for at in range(0, len(whole_batch), ROWS_OUT)):
            x = by.matrix(batch.column("x"))
            out = np.full((len(x), k), np.nan)
            out[:, by.varies] = projected(by, x)
            m, each = len(x), np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(pa.array(each)).cast(key_type), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, by.n, np.int64)), pa.array(deviations(by, x), pa.int64()).take(pa.array(each)),
                pa.array(out.reshape(-1), from_pandas=True), pa.array(explained * m, pa.float64()), pa.array([by.identity_error] * (m * k), pa.float64()),
            ], ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` of every usable vector and component."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = df.select(F.col(key).alias("key"), whole(vector, scale, shift).alias("x")).where("x IS NOT NULL")
    kind = rows.schema["key"].dataType
    made = f"key {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    by = fit(rows, components, shift)
    if by is None:
        return df.sparkSession.createDataFrame([], made).withColumnRenamed("key", key)
    return rows.mapInArrow(whitened_rows(by, to_arrow_type(kind)), made).withColumnRenamed("key", key)
