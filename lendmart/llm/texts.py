"""What several corpus operators share: tables, text normalisation, staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmart.sources.staging import stage

__all__ = ["free_names", "lower_ascii", "read_table", "stage", "text_of"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that are none of ``taken``, whatever the case, nor of each other."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; texts of plain ASCII take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
