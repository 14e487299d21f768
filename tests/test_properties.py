"""Equivalences between plans, idempotence of writes, behaviour under skewed keys, plan shape."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.q_marts import catalog
from checks.q_portfolio import AS_OF, SITE
from checks.registry import Inputs
from lendmart.operators import rows
from lendmart.operators import snapshots as snap
from lendmart.plans import lead_details as lead
from lendmart.plans import portfolio
from lendmart.sources import sinks, staging

SF = "/root/testdata/sf0.001"
DAY0 = dt.date(2023, 1, 1)


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF)


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    key = lambda r: tuple(str(r[c]) for c in cols)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_full_equals_refresh_on_the_current_month(inputs):
    full = portfolio.loan_at_monthly_full(catalog(inputs), AS_OF, SITE)
    now = portfolio.loan_at_monthly_current(catalog(inputs), AS_OF, SITE)
    assert len(full.columns) == 47 and full.columns == portfolio.MONTHLY_COLUMNS
    assert [f.dataType for f in full.schema] == [f.dataType for f in now.schema]
    same(full.filter(F.col("status_month") == "1998-06-30"), now)


def test_refresh_replaces_one_month_and_is_idempotent(spark, inputs, tmp_path):
    path = str(tmp_path / "monthly")
    full = staging.stage(portfolio.loan_at_monthly_full(catalog(inputs), AS_OF, SITE), "full")
    now = portfolio.loan_at_monthly_current(catalog(inputs), AS_OF, SITE)
    # Spoil the current month, then repair it twice.
    month = F.col("status_month") == "1998-06-30"
    sinks.write_snapshots(full.withColumn("loan_status", F.when(month, "spoiled").otherwise(F.col("loan_status"))), path)
    for _ in range(2):
        sinks.refresh_snapshots(now, path)
        same(spark.read.schema(full.schema).parquet(path).select(*full.columns), full)


def test_write_mart_replaces(spark, tmp_path):
    path = str(tmp_path / "mart")
    sinks.write_mart(spark.range(5), path)
    sinks.write_mart(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_spine_has_every_month_once(spark):
    loans = spark.createDataFrame([(1, dt.date(2024, 1, 31)), (2, dt.date(2024, 3, 1)), (3, dt.date(2024, 4, 1)), (4, None)], "loan_id long, disburse_date date")
    got = [(r.loan_id, str(r.status_month)) for r in snap.loan_month_spine(loans, "2024-03-15").orderBy("loan_id", "status_month").collect()]
    assert got == [(1, "2024-01-31"), (1, "2024-02-29"), (1, "2024-03-31"), (2, "2024-03-31")]


def test_month_list_restricts_the_spine(spark):
    loans = spark.createDataFrame([(1, dt.date(2024, 1, 31))], "loan_id long, disburse_date date")
    months = spark.createDataFrame([(dt.date(2024, 2, 29),)], "months date")
    assert [str(r.status_month) for r in snap.loan_month_spine(loans, "2024-03-15", months).collect()] == ["2024-02-29"]


def test_to_collect_never_exceeds_total_due(inputs):
    m = portfolio.loan_at_monthly_full(catalog(inputs), AS_OF, SITE)
    assert m.filter(F.col("due_principal_to_collect") > F.col("total_due_principal")).count() == 0
    assert m.filter(F.col("dpdcurrent_classification").isNull()).count() == 0


# --- skewed keys: a third of all rows under one key ------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    data = [(n, 1 if n % 3 == 0 else rnd.randrange(2, 60), DAY0 + dt.timedelta(days=rnd.randrange(40)), rnd.choice(["a", "b", None])) for n in range(3000)]
    return spark.createDataFrame(data, "id long, key long, day date, v string").repartition(6).cache()


def test_numbering_under_skew(skewed):
    w = Window.partitionBy("key").orderBy("day", "id")
    want = skewed.withColumn("no", F.row_number().over(w).cast("long")).withColumn("before", F.lag("v").over(w))
    same(rows.numbered_with_previous(skewed, "key", "day", "id", "no", {"before": "v"}), want)


def test_dense_positions_under_skew(skewed):
    want = skewed.withColumn("r", F.dense_rank().over(Window.partitionBy("key").orderBy("day")))
    same(rows.dense_positions(skewed, "key", "day", "r"), want)


def test_latest_value_keeps_null_of_the_newest_row(skewed):
    got = {r.key: r.x for r in rows.latest_value(skewed, "key", {"x": (F.col("day") > DAY0, F.col("v"))}).collect()}
    best = {}
    for r in skewed.filter(F.col("day") > DAY0).collect():
        if r.key not in best or r.id > best[r.key][0]:
            best[r.key] = (r.id, r.v)
    assert got == {k: v for k, (_, v) in best.items()}


def test_asof_under_skew(spark, skewed):
    events = spark.createDataFrame([(k, DAY0 + dt.timedelta(days=k % 40)) for k in range(1, 60, 2)], "key long, event date")
    got = {r.key: (r.v, r.day) for r in rows.asof_score(skewed, events, "key", "v", "day", "event", "id").collect()}
    limit = {r.key: r.event for r in events.collect()}
    best = {}
    for r in skewed.collect():
        if r.key in limit and r.day > limit[r.key]:
            continue
        if r.key not in best or (r.day, r.id) > best[r.key][0]:
            best[r.key] = ((r.day, r.id), (r.v, r.day))
    assert got == {k: x for k, (_, x) in best.items()}


def test_earliest_match_under_skew(spark):
    rnd = random.Random(3)
    right = [(n, rnd.choice(["hot", "hot", "p1", "p2", None]), rnd.choice(["id1", "id2", "", None]), rnd.choice([None, DAY0, DAY0 + dt.timedelta(days=n % 5)])) for n in range(400)]
    left = [(n, rnd.choice(["hot", "p1", "p9", None]), rnd.choice(["id1", "id9", "", None])) for n in range(300)]
    r = spark.createDataFrame(right, "rid long, phone string, nid string, day date")
    lf = spark.createDataFrame(left, "id long, phone string, nid string")
    got = {x.id: (x.rid, x.day) for x in rows.earliest_match(
        lf, r.withColumnsRenamed({"phone": "rphone", "nid": "rnid"}), [("phone", "rphone", None), ("nid", "rnid", F.col("rnid") != "")], ["day", "rid"], ["rid", "day"]).collect()}
    late = dt.date(9999, 1, 1)
    for n, phone, nid in left:
        cand = [(d or late, k, d) for k, p, q, d in right if (phone and p == phone) or (nid and q == nid)]
        want = (min(cand)[1], min(cand)[2]) if cand else (None, None)
        assert got[n] == want


def test_monthly_figures_against_brute_force(spark):
    rnd = random.Random(11)
    data = []
    for n in range(400):
        due = DAY0 + dt.timedelta(days=rnd.randrange(300))
        data.append((1 if n % 3 == 0 else rnd.randrange(2, 6), due, rnd.choice(["paid", "due", "closed"]), due + dt.timedelta(days=rnd.choice([-20, 0, 3, 5, 31, 90])),
                     DAY0, n % 4, 100 + n, 90 + n, 10))
    inst = spark.createDataFrame(data, "loan_id long, due date, state string, updated date, created date, lender int, amount int, principal int, interest int")
    inst = inst.withColumns({m: F.col(m).cast("decimal(18,2)") for m in ("amount", "principal", "interest")})
    spine = snap.loan_month_spine(inst.groupBy("loan_id").agg(F.min("created").alias("disburse_date")), "2023-12-05")
    got = snap.monthly_asof_agg(spine, inst, "2023-12-05").collect()

    def end(d):
        nxt = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return nxt - dt.timedelta(days=1)

    assert len(got) == 5 * 12
    for g in got:
        m = g.status_month
        mine = [x for x in data if x[0] == g.loan_id]
        open_m = [x for x in mine if x[2] == "due" or (x[2] == "paid" and x[3] > m)]
        paid = [x for x in mine if x[2] == "paid" and x[3] <= m]
        late = [x for x in open_m if end(x[1]) <= m]
        assert g.total_paid_amount == sum(x[6] for x in paid)
        assert g.total_due_principal == sum(x[7] for x in open_m)
        assert g.due_amount_to_collect == sum(x[6] for x in late)
        assert g.min_overdue_emi_date == min((x[1] for x in late), default=None)
        assert g.due_emi_date == min((x[1] for x in mine if x[2] == "due" or x[3] > m), default=None)
        assert g.active_count == sum(1 for x in mine if x[2] == "due" or (x[2] == "paid" and x[3] >= m))
        assert g.paid_emi_count == len({end(x[1]) for x in mine if x[2] != "due" and x[3] <= m})
        assert g.last_paid_date == max((x[3] for x in paid), default=None)


# --- the lead mart ---------------------------------------------------------

def test_lead_details_is_unique_and_complete(inputs):
    df = staging.stage(lead.lead_details(catalog(inputs), AS_OF, SITE), "lead_test")
    loans = inputs.raw_loans.join(inputs.raw_users.select("uid"), "uid", "left_semi")
    assert df.count() == loans.count() == df.select("loan_id").distinct().count()
    published = set(lead.BORROWER_COLUMNS.values()) | set(lead.CHANNEL_COLUMNS.values())
    assert published <= set(df.columns) and len(df.columns) >= 350
    # Columns that other marts read.
    assert {"uw_name_final", "uw_status_final", "pq_approved_flag", "payment_registration_vendor", "delist_flag", "crif_score", "user_pan"} <= set(df.columns)


# --- plan shape ------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_rows_are_pruned_before_the_shuffle(inputs):
    plan = plan_of(rows.latest_by(inputs.orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]))
    assert "WindowGroupLimit" in plan and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


@pytest.mark.parametrize("name", ["loan_position", "collection_position", "monthly_asof_agg", "loan_month_spine", "number_installments", "repeat_borrower",
                                  "attribute_campaign", "first_registration", "asof_score", "lead_funnel", "loan_at_monthly_full"])
def test_no_cross_products(spark, name):
    import __spark_entry__ as entry
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(inputs):
    from lendmart.operators import installments as ins
    plan = plan_of(ins.register_rollup(inputs.payment_register, SITE.ignored_payees))
    assert "l_extendedprice" in plan and "l_discount" not in plan and "l_tax" not in plan


def test_staging_folder_comes_from_the_session(spark):
    from types import SimpleNamespace as Stub

    def session(named, master, checkpoint=None):
        conf = Stub(get=lambda key, default=None: named if key == "spark.checkpoint.dir" else default)
        return Stub(conf=conf, sparkContext=Stub(master=master, applicationId="x", getCheckpointDir=lambda: checkpoint))

    assert staging.shared_folder(session("s3://b/ck/", "yarn")) == "s3://b/ck"
    assert staging.shared_folder(session(None, "yarn", "hdfs:///ck")) == "hdfs:///ck"
    with pytest.raises(RuntimeError):
        staging.shared_folder(session(None, "yarn"))
    staged = staging.stage(spark.range(3).withColumn("k", F.col("id") % 2), "probe", "k")
    assert staged.count() == 3 and staged.columns == ["id", "k"]


MISSING = [  # loan, lender, due, created, updated, state, amount
    (1, 10, "2024-01-10", "2024-01-01", "2024-01-10", "paid", 100), (1, 10, "2024-02-10", "2024-01-01", None, "paid", 100),
    (1, 10, "2024-03-10", "2024-01-01", None, "due", 100), (2, 10, None, "2024-01-01", None, "due", 100),
    (2, 10, None, "2024-01-01", "2024-02-20", "paid", 100), (2, 10, "2024-02-01", "2024-01-01", "2024-04-02", "paid", 100),
    (3, 20, "2024-01-31", "2024-01-01", None, "closed", 100), (3, 20, None, "2024-01-01", "2024-03-31", "closed", 100),
]


def test_missing_days_full_equals_refresh(spark):
    """Rows without a settlement or due day: every month of the full build is what a refresh on its last day gives."""
    day = lambda x: dt.date.fromisoformat(x) if x else None
    rows = [(l, u, day(d), day(c), day(s), st, *[Decimal(a)] * 3) for l, u, d, c, s, st, a in MISSING]
    inst = spark.createDataFrame(rows, "loan_id long, lender long, due date, created date, updated date, state string, "
                                       "amount decimal(18,2), principal decimal(18,2), interest decimal(18,2)")
    ends = [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    spine = spark.createDataFrame([(l, m) for l in (1, 2, 3) for m in ends], "loan_id long, status_month date")
    full = snap.monthly_asof_agg(spine, inst, "2024-03-31").drop("bounce_relax_count", "bounce_act_count")
    for end in ends:
        month = F.col("status_month") == F.lit(end)
        now = snap.current_month_agg(spine.filter(month), inst, str(end))
        same(full.filter(month), now.select(*full.columns))
    got = {(r.loan_id, r.status_month): r for r in full.collect()}
    assert got[1, ends[2]].total_paid_amount == 100 and got[1, ends[2]].total_due_amount == 100
    assert got[2, ends[2]].due_amount_to_collect == 100 and got[2, ends[2]].total_due_amount == 200


def test_repeated_source_rows_count_once(spark):
    from lendmart.sources.catalog import Catalog, installments
    rows = [(1, 7, 10, 1704067200, 1704067200, 1704067200, Decimal("5.25"), Decimal(5), Decimal("0.25"), "due", "N")]
    names = "id long, loan_id long, uid_l long, due_date long, created long, udated long, amount decimal(20,4), principal decimal(20,4), interest decimal(20,4), emi_state string, deleted string"
    twice = spark.createDataFrame(rows * 2 + [(2, *rows[0][1:])], names)
    assert installments(Catalog(spark, frames={"installments": twice})).count() == 2
    fine = spark.createDataFrame([(1, 7, 10, 0, 0, 0, Decimal("5.255"), Decimal(5), Decimal(0), "due", "N")], names)
    with pytest.raises(Exception, match="two decimals"):
        installments(Catalog(spark, frames={"installments": fine})).collect()


def test_month_list_from_a_base_folder(spark, tmp_path):
    from lendmart.sources.catalog import Catalog
    base = str(tmp_path)
    assert not Catalog(spark, base=base).has("month_ends")
    spark.createDataFrame([(dt.date(2024, 2, 29),)], "months date").write.parquet(f"{base}/month_ends")
    assert Catalog(spark, base=base).has("month_ends") and Catalog(spark, base=base)["month_ends"].count() == 1
