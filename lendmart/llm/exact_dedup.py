"""Exact deduplication by recipes of content-defined chunks.

Every text is normalised (A-Z lower-cased) and cut into chunks whose borders depend on the content: at least
``MIN_CHUNK`` characters, then up to the next line or sentence end, at most ``MAX_CHUNK``.  Chunks are
deduplicated before they are moved (a chunk that a third of all documents share leaves a map task once), and
an identifier is given out only after the whole corpus has shown that no two different chunks share it.  Two
texts are equal when their ordered identifier lists are; the lists are some hundredth of the text, and they
alone are grouped and joined.

All steps are DataFrame functions.

Defined cases: a null text counts as empty and equals every other empty text; a very long text is one more list of chunks, each moved on its own
(its list alone stands in one row); an empty table gives an empty
result; null ``doc_id`` values order below all others, so such a row stays only where its whole group has none,
and then all rows of that group are alike; rows that repeat a ``doc_id`` with the same text carry the same
verdict and ``drop_duplicates`` leaves one of them; other columns of the input, whatever their names, take no
part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart.llm.texts import free_names, lower_ascii, stage, text_of

MIN_CHUNK, MAX_CHUNK = 512, 4096
BORDER = "\n.!?;。！？"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    """``least`` characters, then a run without a border and the border, or what is left of the text."""
    return f"(?s).{{{least}}}[^{BORDER}]{{0,{most - least - 1}}}+[{BORDER}]?|.{{1,{least}}}"


def chunks_of(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The chunks of a text in order; joined, they give the text again."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern(least, most)), F.lit(0))


def wide_hash(salt: int) -> Callable[[Column], Column]:
    """128 bits from two salted 64-bit hashes."""
    return lambda c: F.struct(F.xxhash64(c, F.lit(2 * salt)).alias("a"), F.xxhash64(F.lit(2 * salt + 1), c).alias("b"))


# Tried in this order until one is verified on the corpus.
SCHEMES: tuple[Callable[[Column], Column], ...] = (wide_hash(0), wide_hash(1), lambda c: F.sha2(c, 512))


def is_verified(texts: DataFrame, scheme: Callable[[Column], Column], least: int, most: int) -> bool:
    """Whether no two different chunks of the corpus share an identifier.  Each distinct chunk is moved once."""
    distinct = texts.select(F.explode(chunks_of(F.col("norm"), least, most)).alias("chunk")).select(
        scheme(F.col("chunk")).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").count().where("count > 1").isEmpty()


def recipes(docs: DataFrame, schemes: Sequence[Callable[[Column], Column]] = SCHEMES,
            least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """``doc_id, text_sha256, recipe`` of every row, written once; the recipe lists verified chunk identifiers."""
    texts = docs.select("doc_id", lower_ascii(text_of()).alias("norm"))
    scheme = next((s for s in schemes if is_verified(texts, s, least, most)), None)
    if scheme is None:
        raise ValueError("no identifier scheme tells all chunks of this corpus apart")
    return stage(texts.select(
        "doc_id", F.sha2(F.col("norm"), 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("norm"), least, most), scheme).alias("recipe")), "recipes")


def groups_of(listed: DataFrame) -> DataFrame:
    """``recipe, keep_id, group_size`` of every different text."""
    return listed.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    listed = recipes(docs, **options)
    # Written, so that the join reads both sides through exchanges of its own and splits a hot text's documents.
    return listed.join(stage(groups_of(listed), "text_groups"), "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The decision is by ``doc_id``, which names a text.  Where ``doc_id`` values repeat, the rows of one
    ``doc_id`` and text are reduced to one by a partial aggregation.
    """
    n_keep, n_sha, n_again, n_digest = free_names(docs.columns, "keep", "sha", "again", "digest")
    listed = recipes(docs, **options)
    keepers = stage(listed.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.max("text_sha256").alias("sha"),
    ).select(F.col("keep_id").alias(n_keep), F.col("sha").alias(n_sha)), "keepers")
    same = docs["doc_id"].eqNullSafe(keepers[n_keep])
    repeats = listed.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(n_again))
    if repeats.isEmpty():
        return docs.join(keepers, same, "left_semi")
    # Some doc_id stands in several rows: the text decides too, and one row of each text stays.
    digest = F.sha2(lower_ascii(text_of(docs["text"])), 256)
    again = stage(repeats, "repeats")
    single = docs.join(again, docs["doc_id"].eqNullSafe(again[n_again]), "left_anti")
    multiple = docs.join(again, docs["doc_id"].eqNullSafe(again[n_again]), "left_semi")
    kept = multiple.join(keepers, multiple["doc_id"].eqNullSafe(keepers[n_keep]) & (digest == keepers[n_sha]), "left_semi")
    one = kept.withColumn(n_digest, F.sha2(lower_ascii(text_of()), 256)).dropDuplicates(["doc_id", n_digest]).drop(n_digest)
    return single.join(keepers, single["doc_id"].eqNullSafe(keepers[n_keep]), "left_semi").unionByName(one)
