"""Ranks and the rows they are attached to read one exchange of the source; rows without a key have none."""

from checks.q_portfolio import idless
from checks.registry import Inputs
from lendmart.operators import installments as ins
from lendmart.operators.bitmaps import bitmap_ranks
from pyspark.sql import functions as F


def test_the_source_is_moved_once(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = ins.number_installments(idless(Inputs(spark, "/root/testdata/sf0.001")))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    moved = [line for line in plan.split("\n") if "REPARTITION_BY_COL" in line]
    assert sum("ReusedExchange" not in line for line in moved) == 1 and len(moved) == 2


def test_rows_without_a_key_have_no_rank_and_count_for_none(spark):
    df = spark.createDataFrame([(None, 1), (None, 5), (0, 3), (0, 5), (7, 5)], "k long, at long")
    for kind in ("long", "string"):
        got = bitmap_ranks(df.withColumn("k", F.col("k").cast(kind)), "k", {"no": (None, F.col("at"))})
        assert got.columns == ["k", "at", "no"]
        assert sorted((str(r.k), r.at, r.no) for r in got.collect()) == [
            ("0", 3, 1), ("0", 5, 2), ("7", 5, 1), ("None", 1, None), ("None", 5, None)]
