"""What keeps the whole lead mart fast: its row goes through joins packed, and is not moved to meet small tables."""

from pyspark.sql import functions as F

from checks.q_marts import catalog
from checks.q_portfolio import AS_OF, SITE
from checks.registry import Inputs
from lendmart.operators import rows
from lendmart.plans import lead_details as lead
from lendmart.sources import staging

SF = "/root/testdata/sf0.001"


def test_packed_rows_come_back(spark):
    df = spark.range(6).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("even"), F.lit("x").alias("add"))
    packed = rows.packed(df, "id", "part")
    assert len(packed.columns) == 2 and rows.packed(df.select("id"), "id", "none").columns == ["id"]
    wide = rows.unpacked(spark.range(4, 9).join(packed, "id", "left"))
    assert wide.columns == df.columns
    assert sorted(map(tuple, wide.collect())) == [(4, 4, "x"), (5, None, "x"), (6, None, None), (7, None, None), (8, None, None)]


def test_the_row_is_packed_in_joins_and_not_moved_for_small_tables(spark):
    staged = {}

    def recorded(df, name, partition_by=None):
        staged[name] = df
        return staging.stage(df, name, partition_by)

    mart = lead.lead_details(catalog(Inputs(spark, SF)), AS_OF, SITE, recorded)
    wide = staged["applications"]._jdf.queryExecution().optimizedPlan()
    join = wide.children().head()
    assert join.nodeName() == "Join" and join.output().size() < 60 and wide.output().size() > 250
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        plan = mart._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin ") >= 5
