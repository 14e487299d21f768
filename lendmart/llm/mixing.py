"""Mixing sources to target weights.

Each source's share of the tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are) and
normalised.  The exponent is found by bisection: the largest that reaches a target entropy, or the smallest whose
most repeated source stays within a repetition limit.  The weights become token budgets.  A budget is realised as
permutations of blocks: a source's documents are dealt into ``BLOCKS`` blocks by a hash of ``doc_id``; every whole
pass over the source takes all blocks in an order of its own, the last pass takes blocks in its order until the budget is
spent (to the nearest block).  ``position`` orders the mixture so that all sources run evenly from 0 to 1.

The plan has one row a source and no more than ``BLOCKS`` blocks in it, so nothing grows with a hot source;
documents get their passes from the plan and their own hash, without moving texts by key.  Without a budget the
mixture is the smallest that holds every document once: small sources repeat, no document is lost.

Defined cases: a null source is a source of its own; a null or empty text has no tokens, but its document takes part
with its block; a very long text is counted whole, makes its block as large as it is, and the budget is met to that block; a source
without tokens is read once; sources of equal size get equal weights; repeated rows fall into the same block and are repeated alike, as are
rows with null ``doc_id``; an empty table gives an empty result; the input's columns stay, whatever their names, and the three new ones
stand in one struct whose name the caller chooses (a column of that name is replaced).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmart.llm.texts import free_names, stage, text_of

BLOCKS = 512
STEPS = 40
REPETITION_LIMIT = 2.0


def token_count(text: Column) -> Column:
    """Words between blanks."""
    trimmed = F.regexp_replace(text, r"^[ \t-\r]+|[ \t-\r]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[ \t-\r]+"))).cast("long")


def block_of(doc_id: Column, seed: int, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(blocks)).cast("int")


def exponent_for_limit(sizes: DataFrame, limit: float) -> float:
    """The smallest exponent at which no source is read more than ``limit`` times as often as another."""
    low, high = sizes.where("tokens > 0").agg(F.min("tokens"), F.max("tokens")).first()
    if not low or low == high:
        return 0.0
    a, b = 0.0, 1.0
    for _ in range(STEPS):
        mid = (a + b) / 2
        # Passes over a source are in proportion to tokens ** (exponent - 1).
        a, b = (a, mid) if (high / low) ** (1 - mid) <= limit else (mid, b)
    return b


def exponent_for_entropy(sizes: DataFrame, entropy: float) -> float:
    """The largest exponent whose weights have at least ``entropy`` nats; 0 if even equal weights have less."""
    some = sizes.where("tokens > 0")
    log_tokens = F.log("tokens")
    top = some.agg(F.max(log_tokens)).first()[0]
    if top is None:
        return 0.0

    def reached(x: float) -> bool:
        power = F.exp(F.lit(x) * (log_tokens - F.lit(top)))
        total, weighted = some.agg(F.sum(power), F.sum(power * F.lit(x) * (log_tokens - F.lit(top)))).first()
        return math.log(total) - weighted / total >= entropy

    if reached(1.0):
        return 1.0
    a, b = 0.0, 1.0
    for _ in range(STEPS // 2):
        mid = (a + b) / 2
        a, b = (mid, b) if reached(mid) else (a, mid)
    return a


def mixing_plan(docs: DataFrame, limit: float = REPETITION_LIMIT, entropy: float | None = None,
                budget: float | None = None, seed: int = 0, blocks: int = BLOCKS) -> DataFrame:
    """One row a source: tokens, weight, budget, whole passes, and the blocks of the last pass in order."""
    counted = stage(docs.select(F.col("source"), block_of(F.col("doc_id"), seed, blocks).alias("block"),
                                token_count(text_of()).alias("tokens"))
                    .groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "block_sizes")
    sizes = counted.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    x = exponent_for_limit(sizes, limit) if entropy is None else exponent_for_entropy(sizes, entropy)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(x))).otherwise(0.0)
    # The mixture in tokens: given, or so large that the least repeated source is read once.
    total, least = sizes.agg(F.sum(power), F.min(F.when(F.col("tokens") > 0, power / F.col("tokens")))).first()
    total, least = total or 1.0, least or 1.0
    whole = total / least if budget is None else float(budget)
    passes = F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(1.0)
    planned = sizes.select("source", F.col("tokens").alias("source_tokens"), (power / F.lit(total)).alias("weight"),
                           (F.col("tokens") * 0 + power / F.lit(total) * F.lit(whole)).alias("budget"), "tokens") \
        .withColumn("passes", F.when(F.abs(passes - F.round(passes)) < 1e-9, F.round(passes)).otherwise(passes)) \
        .withColumn("whole_passes", F.floor("passes").cast("int"))
    # The last pass: blocks in its order while the middle of the block lies within what is left of the budget.
    order = Window.partitionBy("source").orderBy(block_order(F.col("source"), F.col("whole_passes"), F.col("block"), seed), "block")
    last = counted.withColumnRenamed("tokens", "block_tokens").withColumnRenamed("source", "s").join(
        planned, F.col("s").eqNullSafe(F.col("source"))).withColumn(
        "before", F.sum("block_tokens").over(order) - F.col("block_tokens") / 2).withColumn(
        "left", F.col("budget") - F.col("whole_passes") * F.col("source_tokens"))
    taken = F.sort_array(F.collect_list(F.when((F.col("before") < F.col("left")) & (F.col("passes") > F.col("whole_passes")), F.col("block"))))
    return stage(last.groupBy("source", "source_tokens", "weight", "budget", "passes", "whole_passes").agg(taken.alias("last_pass")), "mixing_plan")


def block_order(source: Column, epoch: Column, block: Column, seed: int) -> Column:
    """The place of a block in the permutation of one pass, as a 64-bit number."""
    return F.xxhash64(F.lit(seed + 1), source, epoch, block)


def mix(docs: DataFrame, limit: float = REPETITION_LIMIT, entropy: float | None = None, budget: float | None = None,
        seed: int = 0, blocks: int = BLOCKS, into: str = "mix") -> DataFrame:
    """A row for each time a document is read, with a struct ``into``: ``epoch, block, position``.

    ``position`` sorts the mixture: the pass, and in it the permuted block, as a part of all the source's passes.
    """
    n_source, n_plan, n_block, n_epoch = free_names([*docs.columns, into], "of_source", "plan", "block", "epoch")
    plan = mixing_plan(docs, limit, entropy, budget, seed, blocks).select(
        F.col("source").alias(n_source), F.struct("passes", "whole_passes", "last_pass").alias(n_plan))
    p, block, epoch = F.col(n_plan), F.col(n_block), F.col(n_epoch)
    placed = docs.withColumn(n_block, block_of(F.col("doc_id"), seed, blocks)).join(plan, F.col("source").eqNullSafe(F.col(n_source)))
    times = p["whole_passes"] + F.array_contains(p["last_pass"], block).cast("int")
    repeated = placed.withColumn(n_epoch, F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
    place = F.pmod(block_order(F.col("source"), epoch, block, seed), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # Documents of a block keep together, in an order of their own in each pass.
    within = F.pmod(F.xxhash64(F.lit(seed + 2), epoch, F.col("doc_id")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    spread = F.least(F.lit(1.0), p["passes"] - epoch)
    position = (epoch + spread * (place + within / blocks / 1000)) / F.greatest(p["passes"], F.lit(1.0))
    return repeated.withColumn(into, F.struct(epoch.alias("epoch"), block.alias("block"), position.alias("position"))) \
        .drop(n_block, n_source, n_plan, n_epoch)


def in_order(mixed: DataFrame, by: str = "mix", partitions: int | None = None) -> DataFrame:
    """The mixture in the order of its positions: partitions hold ranges of them, and their rows stand in order.

    Written to files, part after part, the rows are read as the mixture says.
    """
    place, doc = F.col(f"{by}.position"), F.col("doc_id")
    ranged = mixed.repartitionByRange(place, doc) if partitions is None else mixed.repartitionByRange(partitions, place, doc)
    return ranged.sortWithinPartitions(place, doc)
