"""Registry of queries: a Spark callable and, where SQL can say the same, its counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# The SQL as registered, with the views it names: parts of the larger statements.
RAW: dict[str, tuple[str, str]] = {}


class Inputs:
    """The shared views as DataFrames, and the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in views.TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return views.view(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None, uses: str = "", materialize: bool = False):
    """Register ``fn(inputs) -> DataFrame``; ``uses`` lists the views the SQL names."""
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            RAW[name] = (sql, uses)
            ORACLES[name] = views.oracle(sql, *uses.split(), materialize=materialize)
        return fn
    return wrap
