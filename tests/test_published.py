"""Versions of a table, prefix sums over a hot day, scores at many events, logs filtered where they are read."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendmart.operators import rows
from lendmart.sources import sinks
from lendmart.sources.catalog import Catalog


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    key = lambda r: tuple(str(r[c]) for c in cols)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


# --- versioned publish ------------------------------------------------------

def test_open_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "mart")
    assert sinks.current_version(spark, path) is None
    open_table = lambda: Catalog(spark, mapping={"m": path})["m"]
    made = [sinks.publish(spark.range(5), path)]
    first = open_table()
    made.append(sinks.publish(spark.range(9).withColumn("k", F.col("id") % 2), path, partition_by="k"))
    second = open_table()
    assert (first.count(), second.count(), second.columns) == (5, 9, ["id", "k"])
    assert sinks.versions(spark, path) == made and sinks.current_version(spark, path) == made[-1]
    # The old version goes when it is asked to, the current one never.
    assert sinks.drop_versions(spark, path) == [] and first.count() == 5
    assert sinks.drop_versions(spark, path, keep=0) == made[:1] and sinks.drop_versions(spark, path, keep=0) == []
    assert open_table().count() == 9


def test_failed_and_unfinished_builds_are_not_published(spark, tmp_path):
    path = str(tmp_path / "mart")
    made = sinks.publish(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.publish(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    spark.range(7).write.parquet(f"{path}/version=99999999999999999999-unfinished")
    assert sinks.current_version(spark, path) == made and Catalog(spark, mapping={"m": path})["m"].count() == 3
    sinks.drop_versions(spark, path, keep=0)
    assert any(v.endswith("unfinished") for v in sinks.versions(spark, path)) and Catalog(spark, base=str(tmp_path))["mart"].count() == 3


def test_plain_folders_are_read_as_before(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert Catalog(spark, base=str(tmp_path))["plain"].count() == 4


# --- prefix sums ------------------------------------------------------------

@pytest.fixture(scope="module")
def one_day(spark):
    """One identity on one day, and a few others; tie-breakers are unique."""
    rnd = random.Random(4)
    day = dt.date(2024, 1, 1)
    ids = rnd.sample(range(-2000, 6000), 3000)
    data = [(n, 1 if k < 2400 else rnd.choice([1, 2, 3, None]), day if k < 2400 else rnd.choice([day, dt.date(2023, 5, 5), dt.date(2024, 2, 2)]), rnd.choice(["a", "b", None]))
            for k, n in enumerate(ids)]
    return spark.createDataFrame(data, "id long, key long, day date, v string").repartition(7)


@pytest.mark.parametrize("size", [1, 64, 1000, rows.TIE_RANGE])
def test_prefix_sums(one_day, size):
    w = Window.partitionBy("key").orderBy("day", "id")
    known = F.col("key").isNotNull()
    want = one_day.withColumn("no", F.when(known, F.row_number().over(w)).cast("long")).withColumn("before", F.when(known, F.lag("v").over(w)))
    got = rows.numbered_with_previous(one_day, "key", "day", "id", "no", {"before": "v"}, tie_range=size)
    same(got.filter(known), want.filter(known))
    assert got.count() == one_day.count()


def test_a_hot_day_is_sorted_by_many_tasks(spark, one_day):
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows.numbered_with_previous(one_day, "key", "day", "id", "no", {"before": "v"}, tie_range=100)
        hot = got.filter("key = 1 AND day = '2024-01-01'").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) >= 4 and max(r[1] for r in hot) < 2400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)


# --- scores at many events --------------------------------------------------

@pytest.mark.parametrize("bucket", ["week", "month", "year"])
def test_scores_at_many_events(spark, bucket):
    rnd = random.Random(8)
    day = lambda n: dt.date(2023, 11, 1) + dt.timedelta(days=n)
    key = lambda: rnd.choice([1, 1, 1, 2, 3, 4, 5])
    scores = [(key(), rnd.choice([None, "10", "20", "30"]), day(rnd.randrange(150)) if rnd.random() < 0.95 else None, n) for n in range(300)] + [(9, "1", day(3), 1000)]
    events = [(key(), day(rnd.randrange(160)) if rnd.random() < 0.95 else None) for _ in range(200)] + [(7, day(9))]
    s = spark.createDataFrame(scores, "k long, score string, d date, id long").repartition(3)
    e = spark.createDataFrame(events, "k long, at date").repartition(3)
    got = {(r.k, r.at): (r.score, r.d) for r in rows.asof_events(s, e, "k", "score", "d", "at", "id", bucket).collect()}
    want = {}
    for k, at in events:
        found = [(d, n, v) for kk, v, d, n in scores if kk == k and d is not None and at is not None and d <= at]
        want[k, at] = (max(found, key=lambda x: x[:2])[2], max(found, key=lambda x: x[:2])[0]) if found else (None, None)
    assert got == want
    plan = rows.asof_events(s, e, "k", "score", "d", "at", "id", bucket)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


# --- logs of recent leads ---------------------------------------------------

def test_old_log_rows_are_dropped_at_the_scan(spark, tmp_path):
    from checks.q_marts import SITE, catalog
    from checks.registry import Inputs
    from lendmart.plans.lead_funnel import lead_funnel
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    frames = {}
    for name, view in (("lead_details", "leads"), ("lender_rule_log", "lender_rule_log"), ("lender_eligibility", "lender_eligibility")):
        getattr(inputs, view).write.parquet(str(tmp_path / name))
        frames[name] = (lambda name=name: spark.read.parquet(str(tmp_path / name)))
    plain = lead_funnel(catalog(inputs, **frames), SITE)
    want = sorted(map(str, plain.collect()))
    large = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = {k: spark.conf.get(k) for k in (large, "spark.sql.autoBroadcastJoinThreshold")}
    try:
        # As if the logs were large: no broadcast, and a scan of any size is worth a filter.
        spark.conf.set(large, "1")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = lead_funnel(catalog(inputs, **frames), SITE)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("might_contain") >= 2 and sorted(map(str, got.collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
