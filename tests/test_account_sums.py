"""Money of accounts is added up as whole hundredths and becomes money once an account."""

import datetime as dt
from decimal import Decimal

import pytest

from checks.q_portfolio import AS_OF, SITE
from lendmart.operators import installments as ins
from lendmart.plans import portfolio

COLUMNS = ("loan_id long, lender long, due date, created date, updated date, state string, "
           "amount decimal(18,2), principal decimal(18,2), interest decimal(18,2)")
BUILDERS = {
    "loan_position": lambda df: portfolio.loan_position(df, AS_OF, SITE),
    "collection_position": lambda df: portfolio.collection_position(df, AS_OF, SITE),
    "period_sums": lambda df: ins.period_sums(df, AS_OF),
    "loan_totals": ins.loan_totals,
}


def rows(spark, amount="9999999999999999.99"):
    day = dt.date(1998, 1, 5)
    return spark.createDataFrame(
        [(1, 10, day.replace(month=m), day, day.replace(month=m), "paid" if m < 4 else "due", Decimal(amount), Decimal(amount), Decimal(0))
         for m in range(1, 9)], COLUMNS)


@pytest.mark.parametrize("name", BUILDERS)
def test_months_move_without_decimals(spark, name):
    """What a (loan, month) sends to its loan holds longs; only the rows of accounts have decimals."""
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = BUILDERS[name](rows(spark))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    lines = plan.split("\n")
    accounts = next(k for k, line in enumerate(lines) if "Aggregate [" in line)
    assert not [line for line in lines[accounts + 1:] if "decimal(28,2)" in line]


def test_sums_of_the_largest_amounts_are_exact(spark):
    largest = Decimal("9999999999999999.99")
    got = portfolio.loan_position(rows(spark), AS_OF, SITE).first()
    assert (got.amount_total, got.emi_total_paid, got.current_total_due_amount) == (8 * largest, 3 * largest, 5 * largest)
    assert got.first_emi_amount == got.loan_emi_amount == largest
    assert ins.period_sums(rows(spark), AS_OF).first().loan_total_amount == 8 * largest


def test_kinds_of_columns_stay(spark):
    kinds = dict(portfolio.loan_position(rows(spark), AS_OF, SITE).dtypes)
    assert {kinds[c] for c in ("amount_total", "first_emi_amount", "loan_emi_amount", "current_due_amount")} == {"decimal(38,2)"}
    assert dict(ins.last_installment_amount(rows(spark)).dtypes)["emi"] == "decimal(28,2)"
