"""Spark session settings the marts are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings that may be applied to a session somebody else created.
RUNTIME_SETTINGS = {
    # Re-plan at run time: coalesce, switch to broadcast by *measured* size, split skew.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows of large logs that a selective side cannot match are dropped by a Bloom filter before their shuffle.  The
    # filter is built when its side is small enough to be worth it and never holds more than so many keys and bits.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "134217728",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


# The marts' shuffles start with many parts, which are joined to such of the advisory size: a task's share does not grow with
# the input.  The corpus operators size their own parts: for them the session's own values hold.
MART_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "800",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
}
# Under such a key a session keeps the value that a mart setting took the place of.
REPLACED = "lendmart.replaced."


def tune(spark: SparkSession, marts: bool = True) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in MART_SETTINGS.items():
        now = spark.conf.get(key, None)
        if marts and now != value:
            _put(spark, REPLACED + key, now)
            spark.conf.set(key, value)
        elif not marts and now == value:
            _put(spark, key, spark.conf.get(REPLACED + key, None))
    return spark


def _put(spark: SparkSession, key: str, value: str | None) -> None:
    if value is None:
        spark.conf.unset(key)
    else:
        spark.conf.set(key, value)


def build_session(app_name: str = "lendmart", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **MART_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
