"""Ingest without row ids, ranks from bitmaps, and snapshots from one cube: results and plans."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.q_marts import catalog
from checks.q_portfolio import AS_OF, SITE
from checks.registry import Inputs
from lendmart.operators import installments as ins
from lendmart.operators.bitmaps import bitmap_ranks, day_number, month_number
from lendmart.plans import portfolio
from lendmart.sources.catalog import Catalog, installments

SF = "/root/testdata/sf0.001"
RAW = "loan_id long, uid_l long, due_date long, created long, udated long, amount decimal(18,2), principal decimal(18,2), interest decimal(18,2), emi_state string, deleted string, note string"


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """The marts' sources, with the installments as a table of their own."""
    inputs = Inputs(spark, SF)
    path = str(tmp_path_factory.mktemp("raw") / "raw_installments")
    inputs.raw_installments.write.parquet(path)
    return catalog(inputs, installments=lambda: spark.read.parquet(path))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    key = lambda r: tuple(str(r[c]) for c in cols)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


# --- ingest -----------------------------------------------------------------

def test_rows_without_ids_that_differ_anywhere_stay(spark):
    row = [7, 10, 1704067200, 1704067200, 1704067200, Decimal("5.25"), Decimal(5), Decimal("0.25"), "due", "N", "a"]
    change = lambda k, v: [*row[:k], v, *row[k + 1:]]
    rows = [row, row, row, change(2, row[2] + 1), change(10, "b"), change(10, None), change(2, None), change(4, None), change(4, None)]
    for co_partitioned in (True, False):
        got = installments(Catalog(spark, frames={"installments": spark.createDataFrame(rows, RAW).repartition(4)}), co_partitioned=co_partitioned)
        assert got.count() == 6 and got.filter("due = '2024-01-01'").count() == 5 and got.filter("updated IS NULL").count() == 1
        assert ins.loan_totals(got).first().amount_total == 6 * Decimal("5.25")


def test_copies_are_removed_where_the_aggregate_works(sources):
    """The source is moved once, by (loan, due month), and months are added up without another movement."""
    plan = plan_of(ins.by_month(installments(sources), {"n": F.count(F.lit(1))}))
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_COL" in plan and plan.count("Scan parquet") == 1


# --- ranks from bitmaps -----------------------------------------------------

def test_bitmap_ranks_under_skew(spark):
    """A third of all rows under one key; early, late and missing days; parts that are missing."""
    rnd = random.Random(5)
    days = [dt.date(1, 1, 1), dt.date(1899, 12, 31), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31), None]
    day = lambda: rnd.choice(days) if rnd.random() < 0.1 else dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(900))
    rows = [(n, None if n % 97 == 0 else 1 if n % 3 == 0 else rnd.randrange(2, 40), day(), rnd.choice([None, dt.date(2020, 1, rnd.randrange(1, 9))])) for n in range(3000)]
    df = spark.createDataFrame(rows, "id long, k long, due date, made date").repartition(5)
    got = bitmap_ranks(df, "k", {"by_day": (None, day_number("due")), "by_month": (None, month_number("due")), "in_part": (day_number("made"), month_number("due"))})
    rank = lambda by, order: F.when(F.col("k").isNotNull(), F.dense_rank().over(Window.partitionBy(*by).orderBy(order.asc_nulls_last())))
    month = F.trunc("due", "month")
    same(got, df.withColumns({"by_day": rank(["k"], F.col("due")), "by_month": rank(["k"], month), "in_part": rank(["k", "made"], month)}))
    assert bitmap_ranks(df.limit(0), "k", {"r": (None, day_number("due"))}).count() == 0


def test_numbers_take_one_join_and_no_window(sources):
    plan = plan_of(ins.number_installments(installments(sources)))
    assert "Window" not in plan and len(re.findall(r"\w+Join ", plan.split("Initial Plan")[0])) == 1
    # One movement of the source on either side of the join; words and lists of a loan on one.
    assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("Exchange") <= 5


# --- snapshots from one cube ------------------------------------------------

@pytest.mark.parametrize("build", [portfolio.loan_at_monthly_full, portfolio.loan_at_monthly_current])
def test_monthly_marts_move_the_source_once(sources, build):
    plan = plan_of(build(sources, AS_OF, SITE))
    moved = [line for line in plan.splitlines() if "Exchange" in line and "__month" in line]
    raw = [line for line in plan.splitlines() if "Scan parquet" in line and "raw_installments" in line]
    assert len(moved) == 1 and len(raw) == 1


def test_full_build_fills_months_without_changes(spark):
    """A loan disbursed long before its first installment, one without due days, one that ends early."""
    raw = [(1, 10, "2024-03-10", "2023-11-20", "2024-05-02", "paid"), (1, 10, "2024-07-31", "2023-11-20", None, "due"),
           (2, 10, None, "2024-01-31", None, "due"), (2, 10, None, "2024-01-31", "2024-04-30", "paid"),
           (3, 20, "2024-01-05", "2024-01-01", "2024-01-05", "paid"), (3, 20, "2024-02-05", "2024-01-01", "2024-02-29", "closed"),
           (4, 20, "2025-02-05", "2024-06-30", None, "due"), (5, 20, "2024-02-05", "2024-12-01", None, "due")]
    day = lambda x: dt.date.fromisoformat(x) if x else None
    inst = spark.createDataFrame([(a, b, day(c), day(d), day(e), f, *[Decimal(100 + n)] * 3) for n, (a, b, c, d, e, f) in enumerate(raw)],
                                 "loan_id long, lender long, due date, created date, updated date, state string, "
                                 "amount decimal(18,2), principal decimal(18,2), interest decimal(18,2)")
    none = spark.createDataFrame([], "loan_id long, first_day date, last_day date")
    from lendmart.operators import snapshots as snap
    at = "2024-08-15"
    full = snap.monthly_frame(inst, none, at, SITE.priority_lenders, "other")
    loans = snap.with_disbursal(snap.loan_summary(inst, SITE.priority_lenders, "other"), none)
    spine = snap.loan_month_spine(loans, at)
    want = snap.monthly_asof_agg(spine, inst, at).join(spine, ["loan_id", "status_month"])
    same(full, want.select(*full.columns))
    assert full.filter("loan_id = 1").count() == 10 and full.filter("loan_id = 5").count() == 0 and full.filter("loan_id = 2").count() == 8
    for end in ("2023-11-30", "2024-02-29", "2024-04-30", "2024-08-31"):
        now = snap.current_frame(inst, none, end, SITE.priority_lenders, "other")
        month = full.filter(F.col("status_month") == end)
        same(month.drop("bounce_relax_count", "bounce_act_count"), now.select(*full.columns).drop("bounce_relax_count", "bounce_act_count"))
    listed = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 5, 31),)], "months date")
    same(snap.monthly_frame(inst, none, at, SITE.priority_lenders, "other", listed), full.filter("status_month IN ('2024-02-29', '2024-05-31')"))
