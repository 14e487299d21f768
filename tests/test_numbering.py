"""Sequence numbers: rows are moved once for their order and for the figures of their part."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendmart.operators import rows


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("numbers") / "rows")
    spark.sql("""SELECT CASE WHEN id % 50 = 0 THEN NULL ELSE id % 7 END AS key, CASE WHEN id % 41 <> 0 THEN date_add(DATE '2024-01-01', CAST(id % 9 AS INT)) END AS day,
                 id, CASE WHEN id % 3 = 0 THEN NULL ELSE id * 10 END AS v, 'other' AS unused FROM range(2000)""").write.parquet(path)
    return spark.read.parquet(path)


def numbered(table, whole):
    df = table if whole else table.withColumn("tie", F.struct("id", "v"))
    return rows.numbered_with_previous(df, "key", "day", "id" if whole else "tie", "no", {"before": "v"}, tie_range=300)


@pytest.mark.parametrize("whole", [True, False])
def test_numbers_and_values_before(table, whole):
    got = {r.id: r for r in numbered(table, whole).collect()}
    assert len(got) == 2000
    last = {}
    for r in sorted(table.collect(), key=lambda r: (r.key is None, r.key or 0, r.day or dt.date.min, r.id)):
        if r.key is None:
            assert got[r.id].no is None
            continue
        # A missing day comes first and counts, but has no numbers.
        n, before = last.get(r.key, (0, None))
        last[r.key] = n + 1, r.v
        if r.day is None:
            assert got[r.id].no is None
        else:
            assert (got[r.id].no, got[r.id].before) == (n + 1, before)


@pytest.mark.parametrize("whole, most", [(True, 6), (False, 3)])
def test_the_rows_are_moved_once(spark, table, whole, most):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = numbered(table, whole)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    fresh = [line for line in moved if "ReusedExchange" not in line]
    assert sum("REPARTITION_BY_COL" in line for line in fresh) == 1 and any("ReusedExchange" in line for line in moved)
    assert len(fresh) <= most, moved
