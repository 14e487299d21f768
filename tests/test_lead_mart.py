"""The whole lead mart, all columns, against its restatement as one SQL statement."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import multiset
from checks.q_lead_mart import full_oracle
from checks.q_marts import SOURCES, catalog
from checks.q_portfolio import AS_OF, SITE
from checks.registry import Inputs
from checks.views import TABLES
from lendmart.plans import lead_details as lead
from lendmart.sources import staging
from lendmart.sources.catalog import Catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_column(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(full_oracle())
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    df = lead.lead_details(catalog(Inputs(spark, SF)), AS_OF, SITE)
    assert sorted(df.columns) == sorted(cols)
    assert multiset(df.columns, df.collect()) == multiset(cols, want)


# --- the plan: lazy, narrowed, staged in a scope ----------------------------

@pytest.fixture(scope="module")
def plan(spark):
    return lead.LeadMart(catalog(Inputs(spark, SF)), AS_OF, SITE)


def rows_of(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


def test_planning_starts_no_job(spark):
    jobs = lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup())
    sources = catalog(Inputs(spark, SF))
    opened = Catalog(spark, frames={n: sources[n] for n in SOURCES})  # opening a Parquet file reads its schema by a job
    before = jobs()
    made = lead.LeadMart(opened, AS_OF, SITE)
    narrowed = made.select("loan_id", "channel", "uw_live_flag")
    assert len(made.columns) >= 350 and narrowed.columns == ["loan_id", "channel", "uw_live_flag"] and narrowed.needs()[1]
    assert jobs() == before
    with pytest.raises(ValueError, match="no_such"):
        made.select("loan_id", "no_such")


@pytest.fixture(scope="module")
def whole(spark, plan):
    return staging.stage(plan.frame(), "whole_mart")


def test_plan_knows_its_columns(plan, whole):
    assert plan.columns == whole.columns


@pytest.mark.parametrize("columns", [
    ["loan_id", "channel", "sub_category", "category"], ["loan_id", "delist_flag", "uw_live_flag", "call_disposition"],
    ["loan_id", "rm", "ba_name", "ops_remark", "cheque_pending"], ["user_final_city", "loan_id", "comp_city", "account_ifsc", "report_datetime"],
    ["loan_id", "mandate_status", "crif_score", "pq_approved_flag", "registration_fees", "income"]])
def test_narrowed_plans_are_projections(plan, whole, columns):
    columns = [c for c in columns if c in whole.columns]
    got = plan.select(*columns).frame()
    assert got.columns == columns and rows_of(got) == rows_of(whole.select(*columns))


def test_borrowers_stage_only_what_they_use(spark, plan, whole):
    staged = []

    def recorded(df, name, partition_by=None):
        staged.append(name)
        return staging.stage(df, name, partition_by)

    got = lead.lead_borrower(plan, recorded)
    assert rows_of(got) == rows_of(lead.lead_borrower(whole))
    assert sorted(staged) == ["borrowers", "dictionary", "disbursed", "loan_base", "people"]
    text = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Join ") < 20


def test_a_scope_deletes_its_own_tables(spark):
    import os
    folder = f"{staging.shared_folder(spark).removeprefix('file:')}/staging"
    with staging.Scope(spark) as outer:
        kept = outer.stage(spark.range(3), "kept")
        with pytest.raises(RuntimeError):
            with staging.Scope(spark) as inner:
                staged = inner.stage(spark.range(5).withColumn("k", F.col("id") % 2), "gone", "k")
                assert staged.count() == 5 and os.path.isdir(inner.folder.removeprefix("file:"))
                raise RuntimeError
        assert not os.path.exists(inner.folder.removeprefix("file:")) and kept.count() == 3
        a, b = staging.together(lambda: outer.stage(spark.range(2), "a"), lambda: outer.stage(spark.range(4), "b"))
        assert (a.count(), b.count()) == (2, 4) and os.listdir(folder)
    assert not os.path.exists(outer.folder.removeprefix("file:"))
