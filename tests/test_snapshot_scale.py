"""What keeps the installment marts small as their input grows: movements, scans and joins of their plans."""

import os
import re
import time

from pyspark.sql import functions as F

from checks import views
from checks.q_portfolio import AS_OF, SITE
from checks.registry import Inputs
from lendmart.operators import snapshots as snap
from lendmart.plans import portfolio
from lendmart.session import MART_SETTINGS
from lendmart.sources import sinks
from tests.test_installment_plans import SF, plan_of, same, sources  # noqa: F401


def test_snapshots_move_cells_once_and_scan_a_loan_once(spark):
    inst = Inputs(spark, SF).inst
    loans = inst.groupBy("loan_id").agg(F.min("created").alias("disburse_date"))
    plan = plan_of(snap.monthly_asof_agg(snap.loan_month_spine(loans, AS_OF), inst, AS_OF))
    # By due month for the first settlement, by loan for everything else.
    assert len(re.findall(r"\bWindow ", plan)) == 2 and "status_month#" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan))


def test_months_are_filled_in_above_all_joins(sources):  # noqa: F811
    lines = plan_of(portfolio.loan_at_monthly_full(sources, AS_OF, SITE)).splitlines()
    first = lambda word: next(k for k, line in enumerate(lines) if word in line)
    assert first("Generate explode") < first("Join ")


def test_source_views_join_their_tables_once(spark):
    keys = {t: f"parquet.`{SF}/{t}.parquet`" for t in views.TABLES} | {"dayno": "datediff(DAY, DATE '1970-01-01', "}
    for name in ("raw_installments", "raw_installments_idless"):
        view = getattr(Inputs(spark, SF), name)
        assert len(re.findall(r"\w+Join ", plan_of(view))) == 1
        same(view, spark.sql(views._compose([name], f"SELECT * FROM {name}", keys)))


def test_shuffles_start_with_more_parts_than_a_cluster_has_by_default():
    assert int(MART_SETTINGS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) > 200


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    def files():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before = files()
    counts = spark.range(100000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    for name in ("a", "b"):
        sinks.write_snapshots(counts.withColumn("status_month", F.col("k") % 3), str(tmp_path / name))
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.5)
    assert not files() - before
    assert spark.read.parquet(str(tmp_path / "b")).agg(F.sum("n")).first()[0] == 100000
