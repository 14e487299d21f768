"""Hard negatives for contrastive training, found through bounds along a spanning tree of the anchors.

Anchors and candidates are dealt into blocks of bounded size, and each pair of blocks is one group of a task, so work is spread
over anchors times candidates and no task holds more than two blocks.  Within a block the anchors form a minimum spanning tree.  The
root's scores are computed; below it a candidate's score lies within the parent's, plus or minus the length of the edge times
the candidate's norm, and bounds of bounds hold further down.  Only candidates whose bounds overlap a window that is
asked for, and reach the last place of those certain to fill it, are scored anew.  So nothing is approximate: what is skipped cannot
be in the result.

Two passes: the first finds each anchor's positives (the best scores of its own label), the second, for each positive, the best
scores of other labels between two percentages of the positive's score.  Each block contributes as many rows as are asked for; the
best of all blocks are kept.

Scores are inner products of whole numbers and exact; they must fit into a long.  Order is by score, highest first, then by
smaller ``vec_id`` (a null one last), then by place in the table.

Defined cases: a row with a null label or vector takes no part; a shorter vector has zeros at its end, an empty one scores 0; rows that
repeat are rows of their own, so a copy of an anchor is an anchor and another row of its label; a row with a null ``vec_id`` is found like any
other; a positive whose score is negative has an empty window; an anchor without positives, or a positive without negatives, has no rows; an empty
table gives an empty result; columns other than ``vec_id, label, vector``, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmart.llm.texts import stage
from lendmart.llm.vectors import matrix, whole

POSITIVES, NEGATIVES, LOW_PERCENT, HIGH_PERCENT = 5, 10, 30, 90
ANCHORS, CANDIDATES = 2048, 8192   # of a block
SCALE = 256


def whole_components(vector: str) -> Column:
    """``floor(256 * x)`` of every component; null for a vector with a null or non-finite one."""
    return whole(vector, SCALE)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order (each point after its parent, depth first), parents as places in that order (-1: root), and edge lengths."""
    n = len(points)
    p = points.astype(np.float64)
    squared = np.einsum("ij,ij->i", p, p)
    nearest, best, children = np.zeros(n, np.int64), np.full(n, np.inf), [[] for _ in range(n)]
    free, now = np.ones(n, bool), 0
    for _ in range(n - 1):
        free[now] = False
        away = np.maximum(squared + squared[now] - 2 * (p @ p[now]), 0)
        closer = free & (away < best)
        best[closer], nearest[closer] = away[closer], now
        now = int(np.where(free, best, np.inf).argmin())
        children[nearest[now]].append(now)
    order, parents, stack = [], [], [(0, -1)] if n else []
    while stack:
        at, parent = stack.pop()
        stack += [(c, len(order)) for c in reversed(children[at])]
        order.append(at)
        parents.append(parent)
    order = np.array(order, np.int64)
    parents = np.array(parents, np.int64)
    # Lengths anew from differences: a difference of squares loses places.
    edges = np.array([np.sqrt(((p[i] - p[order[up]]) ** 2).sum()) if up >= 0 else 0.0 for i, up in zip(order, parents)], np.float64)
    return order, parents, edges


def tree_of(width: int):
    """A block of anchors with their places in its tree."""
    def rows(block: pa.Table) -> pa.Table:
        order, parents, edges = spanning_tree(matrix(block.column("vector"), width))
        return block.take(pa.array(order)).append_column("place", pa.array(np.arange(len(order), dtype=np.int32))) \
            .append_column("parent", pa.array(parents.astype(np.int32))).append_column("edge", pa.array(edges))
    return rows


class Candidates:
    """A block of candidates that can be scored against anchors."""

    def __init__(self, table: pa.Table, width: int):
        order = pc.sort_indices(table, sort_keys=[("vec_id", "ascending"), ("row", "ascending")], null_placement="at_end")
        table = table.take(order)  # equal scores stand in their order
        self.ids, self.rows = table.column("vec_id").combine_chunks(), table.column("row").to_numpy()
        self.labels = table.column("label").to_numpy()
        whole_numbers = matrix(table.column("vector"), width)
        v = whole_numbers.astype(np.float64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", v, v)) * (1 + 1e-12)
        self.whole, self.most = whole_numbers, float(self.norms.max(initial=0))
        self.kinds: dict = {np.float64: v}

    def scores(self, anchor: np.ndarray, at: np.ndarray | None) -> np.ndarray:
        """Inner products, exact: by the narrowest kind that holds every sum on the way to one."""
        bound = self.most * float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        kind = np.float32 if bound < 1 << 23 else np.float64 if bound < 1 << 52 else object
        if kind not in self.kinds:
            self.kinds[kind] = self.whole.astype(kind)
        m = self.kinds[kind]
        return ((m if at is None else m[at]) @ anchor.astype(kind)).astype(np.int64)


def best_places(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` best scores; of equal scores the smaller place comes first."""
    if len(at) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        scores, at = scores[keep], at[keep]
    return at[np.lexsort((at, -scores))][:k]


def walk(anchors: pa.Table, candidates: Candidates, width: int, asked) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Down the tree: anchor, number of the window, and the places and scores of the best candidates in it.

    ``asked(anchor)`` gives which candidates are allowed, the windows ``(low, high)`` (None: no bound) and how many are wanted of each.
    """
    points = matrix(anchors.column("vector"), width)
    parents, edges = anchors.column("parent").to_numpy(), anchors.column("edge").to_numpy()
    children = np.bincount(parents[parents >= 0], minlength=len(points))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    everyone = np.arange(len(candidates.rows))
    for i, up in enumerate(parents.tolist()):
        allowed, windows, k = asked(i)
        # Scores beyond what doubles tell apart: bounds hold within ``unsure``, and windows are cut by whole numbers.
        largest = candidates.most * float(np.sqrt((points[i].astype(np.float64) ** 2).sum()))
        unsure = 0.0 if largest < 1 << 52 else largest * 1e-14
        if up < 0:
            low = high = candidates.scores(points[i], None).astype(np.float64)
        else:
            low, high = bounds[up]
            children[up] -= 1
            if not children[up]:
                del bounds[up]
            reach = edges[i] * (1 + 1e-9) * candidates.norms + 1e-6 * (1 + np.abs(low) * 1e-9)
            low, high = low - reach, high + reach
            needed = np.zeros(len(everyone), bool)
            for least, most in windows:
                inside = allowed & (high >= least - unsure) & (low <= most + unsure)
                certain = inside & (low >= least + unsure) & (high <= most - unsure)
                if (n := int(certain.sum())) >= k:
                    # So many are certain to be in the window with at least this score.
                    inside &= high >= np.partition(low[certain], n - k)[n - k] - unsure
                needed |= inside
            at = np.flatnonzero(needed)
            if 2 * len(at) > len(everyone):
                low = high = candidates.scores(points[i], None).astype(np.float64)
            elif len(at):
                low[at] = high[at] = candidates.scores(points[i], at)
        if children[i]:
            bounds[i] = low, high
        exact = low == high
        for number, (least, most) in enumerate(windows):
            at = np.flatnonzero(allowed & exact & (low >= least - unsure) & (low <= most + unsure))
            scores = candidates.scores(points[i], at) if unsure else low[at]
            if unsure:
                inside = (scores >= least) & (scores <= most)
                at, scores = at[inside], scores[inside]
            found = best_places(scores, at, k)
            if len(found):
                yield i, number, found, candidates.scores(points[i], found)


def found_in(rows: list, candidates: Candidates, anchor_rows: np.ndarray) -> pa.Table:
    """What ``walk`` yields as a table."""
    lengths = [len(at) for _, _, at, _ in rows]
    at = np.concatenate([at for _, _, at, _ in rows]) if rows else np.zeros(0, np.int64)
    return pa.table({
        "anchor": pa.array(np.repeat(np.array([anchor_rows[i] for i, *_ in rows], np.int64), lengths)),
        "number": pa.array(np.repeat(np.array([w for _, w, *_ in rows], np.int32), lengths)),
        "found_id": candidates.ids.take(pa.array(at)), "found_row": pa.array(candidates.rows[at]),
        "score": pa.array(np.concatenate([s for *_, s in rows]) if rows else np.zeros(0, np.int64), pa.int64())})


FOUND = "anchor long, number int, found_id long, found_row long, score long"


def positives_in(width: int, k: int):
    def pair(anchors: pa.Table, block: pa.Table) -> pa.Table:
        anchors = anchors.sort_by("place")
        candidates = Candidates(block, width)
        own, labels = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
        asked = lambda i: ((candidates.labels == labels[i]) & (candidates.rows != own[i]), [(-np.inf, np.inf)], k)
        return found_in(list(walk(anchors, candidates, width, asked)) if len(anchors) and len(block) else [], candidates, own)
    return pair


def negatives_in(width: int, k: int, low: int, high: int):
    def pair(anchors: pa.Table, block: pa.Table) -> pa.Table:
        anchors = anchors.sort_by("place")
        candidates = Candidates(block, width)
        own, labels, scores = anchors.column("row").to_numpy(), anchors.column("label").to_numpy(), anchors.column("scores").to_pylist()
        # Scores s with low * p <= 100 * s <= high * p, as whole numbers.
        window = lambda p: (-(-low * p // 100), high * p // 100)
        asked = lambda i: (candidates.labels != labels[i], [window(p) for p in scores[i]], k)
        return found_in(list(walk(anchors, candidates, width, asked)) if len(anchors) and len(block) else [], candidates, own)
    return pair


def best_found(anchors: DataFrame, candidates: DataFrame, blocks: tuple[int, int], pair, k: int) -> DataFrame:
    """The best ``k`` of every anchor and window over all pairs of blocks, with their ``rank``."""
    groups, parts = blocks
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tasks = groups * parts
    left = anchors.withColumn("part", every(parts)).repartition(tasks, "group", "part")
    right = candidates.withColumn("group", every(groups)).repartition(tasks, "group", "part")
    found = left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInArrow(pair, FOUND)
    order = Window.partitionBy("anchor", "number").orderBy(F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT,
         anchor_block: int = ANCHORS, candidate_block: int = CANDIDATES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows ``vec_id, label, vector`` of whole numbers.

    ``is_anchor`` is a condition on the input's columns.
    """
    taken = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("vector").cast("array<long>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    # Written, so that a row keeps its number.
    taken = stage(taken, "candidates")
    n, n_anchors, width = taken.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    groups, parts = max(1, -(-n_anchors // anchor_block)), max(1, -(-n // candidate_block))
    candidates = taken.select("row", "vec_id", "label", "vector", F.pmod("row", F.lit(parts)).cast("int").alias("part"))
    anchors = taken.where("is_anchor").select("row", "vec_id", "label", "vector", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"))
    label = taken.schema["label"].dataType.simpleString()
    trees = stage(anchors.groupBy("group").applyInArrow(
        tree_of(width), f"row long, vec_id long, label {label}, vector array<long>, group int, place int, parent int, edge double"), "anchor_trees")
    known = trees.select("row", "label", "vector", "group", "place", "parent", "edge")
    best = stage(best_found(known, candidates, (groups, parts), positives_in(width, positives), positives), "positives")
    lists = best.groupBy(F.col("anchor").alias("of")).agg(F.sort_array(F.collect_list(F.struct("rank", "found_id", "score"))).alias("best"))
    # Every anchor stays: the tree needs them all.
    asking = stage(trees.join(lists, F.col("row") == F.col("of"), "left").drop("of").withColumn("best", F.coalesce("best", F.array().cast(lists.schema["best"].dataType))), "asking")
    windows = asking.select("row", "label", "vector", "group", "place", "parent", "edge", F.col("best.score").alias("scores"))
    hard = best_found(windows, candidates, (groups, parts), negatives_in(width, negatives, low, high), negatives)
    out = hard.join(asking.select("row", F.col("vec_id").alias("anchor_id"), "best"), F.col("anchor") == F.col("row"))
    positive = F.col("best")[F.col("number")]
    return out.select("anchor_id", positive["found_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                      positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
