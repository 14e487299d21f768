"""What keeps the disk of a month-partitioned write small: finished rows do not move."""

import os
import re

from pyspark.sql import functions as F

from lendmart.sources import sinks


def test_finished_rows_are_written_where_they_are(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_snapshots(spark.range(0, 8000, 1, 8).withColumn("status_month", F.col("id") % 3), path)
    names = [f for _, _, files in os.walk(path) for f in files if f.startswith("part-")]
    # Every task writes its own rows of every month; moved rows would have met in fewer tasks.
    assert len({re.match(r"part-(\d+)", f)[1] for f in names}) == 8 and len(names) == 24
    back = spark.read.parquet(path)
    assert back.count() == 8000 and back.filter(F.col("status_month") != F.col("id") % 3).isEmpty()
