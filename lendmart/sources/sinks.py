"""Writing marts as Parquet tables.

``write_mart`` and ``write_snapshots`` replace a folder, ``refresh_snapshots`` its months.  ``publish`` rebuilds without a gap:
every build is a folder of its own (a version), a pointer file names the current one, and it alone is replaced, after
the build is complete.  Who opened the old version goes on reading it; ``Catalog`` follows the pointer when it opens a table;
``drop_versions`` deletes old versions when their readers are done.  The shuffle files of a write are deleted when it ends.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The value of that setting outside all writes, and one entry for each write that runs: steps may write side by side.
_OPEN: list[str] = []
_LOCK = threading.Lock()


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files: a write plans shuffles of its own, which nothing reads after it.

    Without this they stay until the driver's garbage collector finds them, so that a chain of writes adds up on the disks.
    """
    with _LOCK:
        if not _OPEN:
            _OPEN.append(spark.conf.get(CLEANUP, "false"))
        _OPEN.append("true")
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            _OPEN.pop()
            if len(_OPEN) == 1:
                spark.conf.set(CLEANUP, _OPEN.pop())


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and a maker of paths in it."""
    made = spark._jvm.org.apache.hadoop.fs.Path
    return made(path).getFileSystem(spark._jsc.hadoopConfiguration()), made


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the published version; None where nothing is published under ``path``."""
    fs, made = _folder(spark, path)
    pointer = made(f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return f"{path.rstrip('/')}/{name}"


def publish(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write a new version of the table and make it the current one; returns its folder."""
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with own_shuffles(spark):
        writer.parquet(f"{path}/{name}")
    fs, made = _folder(spark, path)
    # The pointer is written beside and renamed over the old one.
    beside = made(f"{path}/{POINTER}.{uuid.uuid4().hex[:8]}")
    out = fs.create(beside)
    out.write(bytearray(name.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    kinds = spark.sparkContext._gateway.new_array(options, 1)
    kinds[0] = options.OVERWRITE
    context.rename(context.makeQualified(beside), context.makeQualified(made(f"{path}/{POINTER}")), kinds)
    return f"{path}/{name}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The folders of all versions, the oldest first."""
    fs, made = _folder(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(made(path)) if s.isDirectory()]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(found) if n.startswith("version=")]


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the current version and the ``keep`` newest ones before it; returns what was deleted.

    Versions newer than the current one are builds that are not published yet, and stay.
    """
    fs, made = _folder(spark, path)
    current = current_version(spark, path)
    old = [v for v in versions(spark, path) if current is not None and v < current]
    gone = old[:len(old) - keep] if keep else old
    for version in gone:
        fs.delete(made(version), True)
    return gone


def write_mart(df: DataFrame, path: str) -> None:
    """Full rebuild: the new files replace the old ones when the job commits."""
    with own_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_snapshots(df: DataFrame, path: str, by: str = "status_month") -> None:
    """Full rebuild of a month-partitioned table.

    The tasks that make the rows write them, a file for each month that a task holds.  The finished rows are not moved
    again: that would need more disk than all movements before it and the table together.
    """
    with own_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)


def refresh_snapshots(df: DataFrame, path: str, by: str = "status_month") -> None:
    """Replace only the months contained in ``df``; running it twice changes nothing."""
    with own_shuffles(df.sparkSession):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(by).parquet(path))
