"""Branches and edges of the column helpers on small hand-made frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions import bands, dates, text
from lendmart.operators import installments as ins
from lendmart.operators import leads as ld

D = dt.date


def one(spark, column, **values):
    """Evaluate a column over a single row."""
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    row = [tuple(v for _, v in values.values())]
    return spark.createDataFrame(row, schema).select(column.alias("r")).first().r


@pytest.mark.parametrize("raw, want", [
    ("05102017", D(2017, 10, 5)), ("05-10-2017", D(2017, 10, 5)), ("5/10/2017", D(2017, 10, 5)), ("31022024", None),
    ("29022023", None), ("29022024", D(2024, 2, 29)), ("00102017", None), ("", None), (None, None), ("123", None),
    ("050102017", D(2017, 10, 5)), ("1514764800", D(2018, 1, 1)), ("abc", None), ("12345678901", None), ("32012020", None),
])
def test_parse_messy_date(spark, raw, want):
    assert one(spark, dates.parse_messy_date("x", repairs=fv.START_DATE_REPAIRS), x=("string", raw)) == want


@pytest.mark.parametrize("raw, want", [
    ("+91-9876543210", "9876543210"), ("09876543210", "9876543210"), ("919876543210", "9876543210"), ("5876543210", None),
    ("987654321", None), (None, None), ("", None), ("98765 43210 ", "9876543210"),
])
def test_normalize_phone(spark, raw, want):
    assert one(spark, text.normalize_phone("x"), x=("string", raw)) == want


@pytest.mark.parametrize("raw, want", [
    ("fc_invalid_abcde1234f", "ABCDE1234F"), ("ABCDE1234F", "ABCDE1234F"), ("abcde1234f_invalid", "ABCDE1234F"), ("abcd1234f", None), (None, None),
])
def test_extract_national_id(spark, raw, want):
    assert one(spark, text.extract_national_id("x"), x=("string", raw)) == want


@pytest.mark.parametrize("raw, want", [("1005.", 1005), (" 77'", 77), ("12345678901", None), ("", None), ("x1", None), (None, None)])
def test_clean_entity_id(spark, raw, want):
    assert one(spark, text.clean_entity_id("x"), x=("string", raw)) == want


@pytest.mark.parametrize("value, want", [
    (0, D(1970, 1, 1)), (-86400, D(1969, 12, 31)), (2147463847, D(2038, 1, 19)), (2147463848, D(2038, 1, 19)), (2147483648, None), (None, None),
])
def test_safe_epoch_date(spark, value, want):
    assert one(spark, dates.safe_epoch_date("x"), x=("long", value)) == want


@pytest.mark.parametrize("day, want", [(D(2024, 1, 24), D(2024, 1, 31)), (D(2024, 1, 25), D(2024, 2, 29)), (D(2024, 12, 31), D(2025, 1, 31))])
def test_cycle_cutoff(spark, day, want):
    assert one(spark, dates.cycle_cutoff(F.col("x")), x=("date", day)) == want


@pytest.mark.parametrize("a, b, want", [
    (D(2024, 1, 31), D(2024, 2, 29), 1), (D(2024, 1, 1), D(2024, 1, 31), 0), (D(2023, 12, 31), D(2024, 1, 1), 1), (D(2024, 3, 1), D(2024, 1, 31), -2),
])
def test_months_between_counts_boundaries(spark, a, b, want):
    assert one(spark, dates.months_between("a", "b"), a=("date", a), b=("date", b)) == want


@pytest.mark.parametrize("month, day, want", [
    ("jan", "day 5", D(2024, 1, 5)), ("Dec", "31", D(2023, 12, 31)), ("feb", "30", None), ("???", "7", D(2024, 1, 7)), ("mar", "", None),
])
def test_resolve_month_name(spark, month, day, want):
    got = one(spark, dates.resolve_month_name_date("m", "d", "r"), m=("string", month), d=("string", day), r=("date", D(2024, 3, 10)))
    assert got == want


EDGES = [-3, 0, 1, 4, 5, 30, 31, 60, 61, 90, 91, 180, 181, 360, 361]
OPS = ["A1_Current"] * 2 + ["A2_1-30"] * 4 + ["A3_31-60"] * 2 + ["A4_61-90"] * 2 + ["A5_91-180"] * 2 + ["A6_180+"] * 3
OPS[10], OPS[11] = "A5_91-180", "A5_91-180"


def label_of(days, scheme):
    s = bands.SCHEMES[scheme]
    if days <= s.current_upto:
        return s.current
    return next((label for last, label in s.steps if days <= last), s.beyond)


@pytest.mark.parametrize("scheme", ["ops", "finance", "loan", "snapshot"])
def test_bucket_edges(spark, scheme):
    df = spark.createDataFrame([(d,) for d in EDGES], "dpd int").withColumn("first", F.lit(D(2020, 1, 1)))
    got = {r.dpd: r.b for r in df.select("dpd", bands.bucket_dpd("dpd", scheme, "first", F.lit(False), "2024-01-01").alias("b")).collect()}
    assert got == {d: label_of(d, scheme) for d in EDGES}
    assert [got[d] for d in (0, 1, 30, 31)] == (["A1_0-4", "A1_0-4", "A2_5-30", "A3_31-60"] if scheme == "finance" else
                                                [got[0], got[1], got[30], got[31]])


def test_bucket_without_days(spark):
    df = spark.createDataFrame([(1, D(2024, 5, 1), True), (2, D(2020, 1, 1), True), (3, D(2020, 1, 1), False)], "id int, first date, settled boolean")
    df = df.withColumn("dpd", F.lit(None).cast("int"))

    def labels(scheme, window=None):
        c = bands.bucket_dpd("dpd", scheme, "first", F.col("settled"), "2024-01-15", window)
        return [r.b for r in df.orderBy("id").select(c.alias("b")).collect()]

    assert labels("ops") == ["A8_Future EMI", "A7_Closed", "A1_Current"]
    # A settled loan is closed even when its first installment lies ahead.
    assert labels("loan") == ["A7_Closed", "A7_Closed", "A1_Current"]
    assert labels("finance_window", ("2024-05-01", "2024-05-31")) == ["A0_1st EMI", "A8_Closed", "A1_0-4"]


def test_legacy_labels_differ_only_at_the_end(spark):
    new, old = bands.SCHEMES["finance_window"], bands.SCHEMES["finance_window_legacy"]
    assert (old.beyond, old.steps[-1]) == ("A6_360+", (360, "A5_181-360")) and new.steps[:-1] == old.steps[:-1]


@pytest.mark.parametrize("value, want", [(None, "Unrated"), (11.99, "1.Premium"), (12, "2.Minimal"), (14, "2.Minimal"), (14.01, "3.Low"), (30, "6.Very High"), (30.5, "Unrated")])
def test_risk_bucket(spark, value, want):
    assert one(spark, bands.risk_bucket("x"), x=("double", None if value is None else float(value))) == want


@pytest.mark.parametrize("value, want", [(None, "CNF"), (550, "A01 <=550"), (551, "A02 551-575"), (850, "A12 801-850"), (851, "A13 850+")])
def test_score_band(spark, value, want):
    assert one(spark, bands.score_band("x"), x=("int", value)) == want


def test_income_band_distinguishes_blank_from_unreadable(spark):
    rows = [("Salaried Employee", None), ("Salaried Employee", ""), ("Salaried Employee", "x"), ("Self", "43999.99"), ("Self", "44000.00")]
    df = spark.createDataFrame(rows, "e string, i string")
    got = [r.b for r in df.select(bands.income_band("e", text.extract_decimal("i"), "i").alias("b")).collect()]
    assert got == ["SA_NA", "SA_NA", "SA06 44K+", "SE01 <44K", "SE02 44K-51K"]


def test_open_as_of_boundaries(spark):
    df = spark.createDataFrame([("due", D(2020, 1, 1)), ("paid", D(2024, 1, 31)), ("paid", D(2024, 2, 1)), ("closed", D(2024, 2, 1))], "state string, updated date")
    at = "2024-01-31"
    got = df.select(ins.open_as_of(at).alias("s"), ins.open_as_of(at, strict=False).alias("i"), ins.open_as_of(at, settled_states=None).alias("a")).collect()
    assert [r.s for r in got] == [True, False, True, False]
    assert [r.i for r in got] == [True, True, True, False]
    assert [r.a for r in got] == [True, False, True, True]


def test_money_in_minor_units_is_exact(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("9999999999999999.99"),), (Decimal("-5.55"),), (None,)], "amount decimal(18,2)")
    got = [r.m for r in ins.in_minor_units(df, ["amount"]).select(ins.money("amount").alias("m")).collect()]
    assert got == [Decimal("0.01"), Decimal("9999999999999999.99"), Decimal("-5.55"), None]


def test_mandate_with_unknown_status_loses(spark):
    cols = "loan_id long, unique_reference_no string, mandate_status string, rejected_reason string, startdate string, enddate string, deleted string, created long"
    rest = ["bank_holder_name", "email_id", "mobile_no", "bank_name", "branch_name", "account_no", "account_type", "ifsc_code", "umrn", "approved_date"]
    df = spark.createDataFrame([(1, "b", "odd", None, "", "", "N", 0), (1, "z", "Pending", None, "", "", "N", 0), (1, "y", "Pending", None, "", "", "N", 0),
                                (1, "a", "Final Approved", None, "", "", "Y", 0)], cols).select("*", *[F.lit("x").alias(c) for c in rest])
    got = ld.best_mandate(df).collect()
    assert [(r.mandate_id, r.nach_status) for r in got] == [("y", "Pending")]


@pytest.mark.parametrize("start, day, fy, q, m", [(4, D(2024, 3, 31), "FY 2023-24", "Q4", 12), (4, D(2024, 4, 1), "FY 2024-25", "Q1", 1), (4, D(1999, 12, 31), "FY 1999-00", "Q3", 9)])
def test_fiscal_calendar(spark, start, day, fy, q, m):
    df = spark.createDataFrame([(day,)], "d date").select(*[c.alias(n) for n, c in dates.fiscal_calendar("d", start).items()])
    r = df.first()
    assert (r.fy, r.fy_qtr, r.fy_month) == (fy, f"{fy}-{q}", m)


# --- published band edges, value by value -----------------------------------

def labels(spark, band, values, kind="double"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, x {kind}")
    return [r.b for r in df.select("k", band("x").alias("b")).orderBy("k").collect()]


@pytest.mark.parametrize("band, kind, first, edges, last, null", [
    (bands.tenure_band, "int", "A1 <12", [(12, "A2 12-15"), (16, "A3 16-18"), (19, "A4 19-24"), (25, "A5 25-30"), (31, "A6 31-36"), (37, None)], None, None),
    (bands.age_band, "int", "A1 <25", [(25, "A2 25-30"), (31, "A3 31-35"), (36, "A4 36-40"), (41, "A5 41-45"), (46, "A6 46-50"), (51, "A7 51-55"), (56, "A8 55+")], "A8 55+", "A8 55+"),
    (bands.amount_band, "int", "A01 <=25K", [(25001, "A02 25K-50K"), (50001, "A03 50K-1L"), (100001, "A04 1L-1.5L"), (150001, "A05 1.5L-2L"), (200001, "A06 2L-2.5L"),
                                             (250001, "A07 2.5L-3L"), (300001, "A08 3L-5L"), (500001, "A09 5L-7L"), (700001, "A10 7L+")], "A10 7L+", "A10 7L+"),
    (bands.turnaround_band, "int", "A1 Same Day", [(2, "A2 2-4 Days"), (5, "A3 a Week"), (9, "A4 a Fortnight"), (16, "A5 a Month"), (32, "A6 2 Month"), (61, "A7 2+ Month")], "A7 2+ Month", "NA"),
    (bands.vintage_band, "int", "A1 Upto 6M", [(7, "A2 6-12M"), (13, "A3 12-24M"), (25, "A4 24-36M"), (37, "A5 36-60M"), (61, "A6 60+ M")], "A6 60+ M", "NA"),
])
def test_band_edges(spark, band, kind, first, edges, last, null):
    """The value before an edge has the label before it, the edge and what follows its own."""
    values, want, before = [edges[0][0] - 1, None], [first, null], first
    for edge, label in edges:
        values += [edge - 1, edge]
        want += [before, label]
        before = label
    values.append(10**8)
    want.append(last)
    assert labels(spark, band, values, kind) == want


@pytest.mark.parametrize("band, employment, edges", [
    (bands.obligation_before_band, "Salaried", "SA01 <18,18 SA02 18-25,25 SA03 25-32,32 SA04 32-37,37 SA05 37-42,42 SA06 42-48,48 SA07 48-54,54 SA08 54+"),
    (bands.obligation_before_band, "Other", "SE01 <19,19 SE02 19-25,25 SE03 25-32,32 SE04 32-37,37 SE05 37-42,42 SE06 42-48,48 SE07 48-55,55 SE08 55-66,66 SE09 66+"),
    (bands.obligation_after_band, "Salaried", "SA01 <40,40 SA02 40-48,49 SA03 49-55,56 SA04 56-60,61 SA05 61-66,67 SA06 67-70,71 SA07 71-75,76 SA08 76-81,82 SA09 81+"),
    (bands.obligation_after_band, "Other", "SE01 <34,34 SE02 34-40,41 SE03 41-48,49 SE04 49-55,56 SE05 56-62,63 SE06 63-70,71 SE07 71-78,79 SE08 79-84,85 SE09 85+"),
])
def test_obligation_edges(spark, band, employment, edges):
    first, *later = edges.split(",")
    who = fv.SALARIED if employment == "Salaried" else "someone else"
    values, want, before = ["0.5", "", None], [first, first[:2] + "_NA", first[:2] + "_NA"], first
    for part in later:
        edge, label = part.split(" ", 1)
        values += [str(int(edge) - 0.001), edge]
        want += [before, label]
        before = label
    df = spark.createDataFrame([(k, who, v) for k, v in enumerate(values)], "k int, e string, x string").withColumn("v", F.nullif("x", F.lit("")).cast("decimal(10,3)"))
    assert [r.b for r in df.select("k", band("e", "v", "x").alias("b")).orderBy("k").collect()] == want
