"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

Fingerprint: 64 bits; a bit is set when more than half of the document's shingle hashes have it.

Covering: every bit position gets a nonzero vector of ``radius + 1`` bits, and there is one table for every nonzero
vector v of that length, whose mask keeps the positions with an odd product with v.  At most ``radius`` positions
differ in a pair within the radius; their vectors cannot span the space, so some v is orthogonal to all of them and
that table's mask hides every difference: the pair meets in that table for certain, not with a probability.

Only distinct fingerprints are put into tables.  A bucket with more than ``BUCKET`` fingerprints is not capped:
inside it the same covering is laid over the bits its mask has hidden so far, which splits it into smaller buckets and again
keeps every pair.  This ends after a few rounds, since ``FEW_HIDDEN`` hidden bits allow only 4,096 fingerprints.  In buckets of bounded size all pairs are compared and a spanning forest of the verified
links leaves the task, never all pairs.

Defined cases: a null or empty text, or one of blanks only, has fingerprint 0 and is linked like any other; fewer
words than a shingle give one shingle of all words; a very long text is counted whole, in blocks; repeated rows get the same component; a null ``doc_id`` takes no
part in naming a component (null if nothing else is in it); an empty table gives an empty result; other columns of the input,
whatever their names, take no part, and ``keep_one`` returns them.
"""

from __future__ import annotations

import functools
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart.llm.components import component_labels
from lendmart.llm.texts import free_names, stage

SHINGLE, RADIUS, SEED = 3, 3, 42
BUCKET, FEW_HIDDEN = 512, 12
BLOCK = 1 << 15
ALL_BITS = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_of(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint; the text's shingles are counted in blocks of bounded memory."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    columns = [words[k:] for k in range(width)] if len(words) >= width else [[b" ".join(words)]]
    shingles = map(b" ".join, zip(*columns))
    hashed = map(functools.partial(xxhash.xxh64_intdigest, seed=seed), shingles)
    total, ones = 0, np.zeros(64, np.int64)
    while len(block := np.fromiter(islice(hashed, BLOCK), np.uint64)):
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint as a long (its 64 bits)."""
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([signed(fingerprint_of(t, width, seed)) for t in texts], dtype="int64")
    return fingerprints(text)


def hexadecimal(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def covering(hidden: int, radius: int) -> list[int]:
    """Masks over the positions set in ``hidden``, one for every nonzero vector.

    Unit vectors are dealt first, so every mask takes up some position once more than ``radius`` are hidden.
    """
    vectors = sorted(range(1, 1 << (radius + 1)), key=lambda v: (v.bit_count(), v))
    positions = [i for i in range(64) if hidden >> i & 1]
    return [sum(1 << p for k, p in enumerate(positions) if (vectors[k % len(vectors)] & v).bit_count() & 1) for v in vectors]


def forest_of(fingerprints: np.ndarray, radius: int) -> list[dict[str, int]]:
    """A spanning forest of the links within ``radius``, by breadth first search."""
    bits = np.sort(fingerprints.astype(np.int64)).view(np.uint64)
    fresh, edges = np.ones(len(bits), bool), []
    for start in range(len(bits)):
        queue = [start] if fresh[start] else []
        fresh[start] = False
        while queue:
            at = queue.pop()
            reached = np.flatnonzero(fresh & (np.bitwise_count(bits ^ bits[at]) <= radius))
            fresh[reached] = False
            queue.extend(reached)
            edges.extend({"u": signed(int(bits[at])), "v": signed(int(bits[k]))} for k in reached)
    return edges


def near_links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints (column ``f``) that connect all pairs within ``radius``."""
    @F.pandas_udf("array<struct<u:long,v:long>>")
    def forest(buckets: pd.Series) -> pd.Series:
        return pd.Series([forest_of(np.asarray(b), radius) for b in buckets])

    spark = prints.sparkSession
    found: list[DataFrame] = []
    # A bucket is a mask and what it leaves of the fingerprint; at first everything is in one.
    masks, rows = [0], prints.select("f", F.lit(0).cast("long").alias("mask"))
    while True:
        # One row for each mask of this round, whatever the data.
        finer = {m: {m | c for c in covering(ALL_BITS & ~m, radius)} for m in masks}
        if masks == [0]:
            to = F.array(*(F.lit(signed(x)) for x in sorted(finer[0])))
            spread = rows.select("f", F.explode(to).alias("mask"))
        else:
            table = spark.createDataFrame([(signed(m), [signed(x) for x in to]) for m, to in finer.items()], "m long, finer array<long>")
            spread = rows.join(F.broadcast(table), F.col("mask") == F.col("m")).select("f", F.explode("finer").alias("mask")).distinct()
        keyed = spread.select("f", "mask", F.col("f").bitwiseAND(F.col("mask")).alias("key"))
        # Sizes are written, so that the join can split a crowded bucket; the same holds for components below.
        sizes = stage(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket_sizes")
        shared = stage(keyed.join(sizes, ["mask", "key"]), "buckets")
        # A bucket is small by its size, or because its mask hides few bits.
        small = (F.col("n") <= bucket) | (F.bit_count("mask") >= 64 - FEW_HIDDEN)
        lists = shared.where(small).groupBy("mask", "key").agg(F.collect_list("f").alias("fs"))
        found.append(lists.select(F.explode(forest("fs")).alias("e")).select("e.u", "e.v"))
        over = shared.where(~small)
        masks = [r.mask & ALL_BITS for r in over.select("mask").distinct().collect()]  # as many as the table has, at most
        if not masks:
            return functools.reduce(DataFrame.unionByName, found).distinct()
        rows = over.select("f", "mask")


def simhash_groups(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                   bucket: int = BUCKET) -> DataFrame:
    """``doc_id, bits, component_id`` of every row; the component's name is its smallest ``doc_id``."""
    marked = stage(docs.select("doc_id", fingerprint(F.col("text"), width, seed).alias("bits")), "fingerprints")
    names = stage(marked.groupBy("bits").agg(F.min("doc_id").alias("least")).withColumnRenamed("bits", "f"), "distinct_fingerprints")
    labels = component_labels(near_links(names.select("f"), radius, bucket))
    rooted = stage(names.join(labels, F.col("f") == F.col("node"), "left").select("f", "least", F.coalesce("label", "f").alias("root")), "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    named = stage(rooted.join(least, "root").select("f", "component_id"), "components")
    return marked.join(named, F.col("bits") == F.col("f")).select("doc_id", "bits", "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` names a component, with their columns: one document of each group.

    Rows without ``doc_id`` are named by nothing and stay.  Rows that repeat a ``doc_id`` are one document, and
    one of them stays.
    """
    groups = simhash_groups(docs, width, radius, seed)
    n_keep, n_times = free_names(docs.columns, "keep", "times")
    keep = stage(groups.where("doc_id = component_id").groupBy(F.col("component_id").alias(n_keep)).agg(F.count(F.lit(1)).alias(n_times)), "kept")
    same = F.col("doc_id") == F.col(n_keep)
    rest = docs.where("doc_id IS NULL")
    several = F.col(n_times) > 1
    if keep.where(several).isEmpty():
        return docs.join(keep, same, "left_semi").unionByName(rest)
    once = docs.join(keep.where(~several), same, "left_semi")
    again = docs.join(keep.where(several), same, "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(again).unionByName(rest)
