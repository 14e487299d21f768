"""Staging tables: intermediate results written once and read by several consumers.

They live in the shared folder the cluster names in ``spark.checkpoint.dir``, so they
survive the loss of executors, cut the lineage, and have a known size when the joins that
read them are planned.  A path without a scheme lies in the cluster's default file system.
They are deleted by ``release``, at the latest when the driver's Python ends.  A ``Scope`` has a folder and a lifetime of
its own: what is staged in it is gone when it ends, and nothing else.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from lendmart.sources.sinks import own_shuffles

_LOCAL: dict[str, tempfile.TemporaryDirectory] = {}
_MADE: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one for local sessions without a setting."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master.startswith("local"):
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.TemporaryDirectory(prefix="lendmart-")
        return _LOCAL[context.applicationId].name
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to its own staging table and return a reader of it."""
    return _written(df, scratch(df.sparkSession, name), partition_by)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there is deleted by ``release``."""
    path = f"{shared_folder(spark)}/staging/{name}-{uuid.uuid4().hex}"
    _MADE.append((spark, path))
    return path


def _written(df: DataFrame, path: str, partition_by: str | None) -> DataFrame:
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with own_shuffles(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """In place of ``stage``: the frame itself, nothing is written.  For schemas, or where a frame has one consumer."""
    return df


def together(*steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """The results of steps that stage tables independent of each other; their jobs share the cluster."""
    with ThreadPoolExecutor(len(steps) or 1) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


class Scope:
    """Staging tables with a lifetime: ``with Scope(spark) as scope: ... scope.stage(df, "name")``.

    Tables are written when ``stage`` is called and deleted when the scope ends, whether its work succeeded or not; tables
    of other scopes and runs are not touched.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/staging/scope-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        return _written(df, f"{self.folder}/{name}-{uuid.uuid4().hex}", partition_by)

    def __enter__(self) -> "Scope":
        return self

    def __exit__(self, *failure) -> None:
        _delete(self.spark, self.folder)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release() -> None:
    """Delete all staging tables of this process; nothing that reads them may be used afterwards."""
    while _MADE:
        spark, path = _MADE.pop()
        if spark.sparkContext._jsc is None:  # the session has ended, and so has access to the folder
            continue
        _delete(spark, path)


atexit.register(release)
