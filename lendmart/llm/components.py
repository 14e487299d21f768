"""Connected components of a distributed list of links, by alternating large and small stars.

Every round points each node's neighbours at the smallest node in reach, first the larger ones, then the smaller
ones, until nothing moves: then each component is one star around its smallest node.  A round is two
aggregations and two joins over the links; each round is written to the shared folder, so the plan does not grow and a
lost executor costs no more than its tasks.  Hub nodes are handled by a partial aggregation and a skew-split join.

Defined cases: links are undirected; a link with a null end, and one from a node to itself, says nothing, so a node that has only such links has
no label; links that repeat count once; equal smallest nodes cannot be; an empty table gives an empty result; columns other than
``u, v``, whatever their names, take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmart.llm.texts import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    # Written, so that the join can split the links of a hub.
    least = stage(both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("w"), F.least("u", "low").alias("low")), "least")
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            joined.select("u", F.col("low").alias("v")))
    return moved.where("u <> v").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def component_labels(links: DataFrame) -> DataFrame:
    """``node, label`` of every node with a link; ``links`` has long columns ``u, v``; the label is the smallest node."""
    now = stage(links.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        now = stage(_star(_star(now, large=True), large=False), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
