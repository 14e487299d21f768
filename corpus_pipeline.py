"""From raw documents to token ids: each stage works on what its predecessor kept.

Each stage takes and, but for the last, returns the columns of its input, whatever further columns it has and however they are named.  What a
stage does with nulls, empty and very long texts, ties, repeated rows and empty tables is its operator's definition (see there); in short:
texts that are null, empty or short fail the rules; equal texts leave the row with the largest ``doc_id``, near copies that with the smallest;
rows without ``doc_id`` stay unless an equal text has one; a null source is a source of its own; an empty table passes through all stages.
Very long texts are read whole by every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmart.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from lendmart.llm.queries import tokenizer_path
from lendmart.llm.texts import free_names, read_table, stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return quality_rules.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest ``doc_id``."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture reads them, in its order; every document at least once."""
    mix, = free_names(docs.columns, "mix")
    return mixing.in_order(mixing.mix(docs, into=mix), by=mix).drop(mix)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    return bpe.round_trip(docs, tokenizer_path()).select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded")


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources", mixing_stage),
    ("BPE", token_stage),
]

# Measuring texts, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
