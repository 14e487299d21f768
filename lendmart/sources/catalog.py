"""Logical table names -> DataFrames.

A :class:`Catalog` resolves a logical name in this order: a DataFrame given directly, a
table name or path given in ``mapping``, then ``{base}/{name}``.  A path with published versions
(``sinks.publish``) is read in its current version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions.dates import epoch_to_local_date
from lendmart.sources.sinks import current_version

# Logical names of the operational tables the marts read.
SOURCES = (
    "installments", "proposals", "proposal_collections", "loans", "loans_dedup", "loan_detail",
    "dictionary", "state_log", "tu_scores", "crif_scores", "payment_register", "logins", "users",
    "employment", "additional_info", "identity_addresses", "rule_runs", "job_log", "job_steps",
    "rep_assignments", "source_owners", "bank_months", "mandates", "mandate_ledger", "bank_mandates",
    "subscriptions", "cheques", "bank_accounts", "transactions", "bureau_ignore", "lender_rule_log",
    "lender_eligibility", "prospects", "campaign_runs", "campaign_performance", "channel_master",
    "pincode_master", "tenure_master", "uw_master", "month_ends",
)
# Marts that feed other marts.
MARTS = ("lead_details", "loan_details_at_monthly")


class Catalog:
    def __init__(self, spark: SparkSession, base: str | None = None, mapping: dict | None = None,
                 frames: dict | None = None):
        self.spark = spark
        self.base = base.rstrip("/") if base else None
        self.mapping = mapping or {}
        self.frames = dict(frames or {})

    def table(self, name: str) -> DataFrame:
        if name in self.frames:
            found = self.frames[name]
            return found() if callable(found) else found
        target = self.mapping.get(name)
        if target is None:
            if self.base is None:
                raise KeyError(f"no source for table {name!r}")
            target = f"{self.base}/{name}"
        if "/" in target:
            return self.spark.read.parquet(current_version(self.spark, target) or target)
        return self.spark.table(target)

    def has(self, name: str) -> bool:
        """Whether there is such a table; under ``base`` its folder must exist."""
        if name in self.frames or name in self.mapping:
            return True
        if self.base is None:
            return False
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def with_frames(self, **frames: DataFrame) -> "Catalog":
        return Catalog(self.spark, self.base, self.mapping, {**self.frames, **frames})

    def opened(self) -> "Catalog":
        """A catalog of the same tables that opens each of them once, when it is first asked for."""
        class Opened(Catalog):
            def table(opened, name: str) -> DataFrame:
                if name not in opened.frames:
                    opened.frames[name] = self.table(name)
                return opened.frames[name]

            __getitem__ = table

        return Opened(self.spark, self.base, self.mapping)

    __getitem__ = table


def to_long(c: str):
    """Identifiers arrive as numbers or text; unreadable ones become NULL."""
    return F.col(c).try_cast("long").alias(c)


def installments(catalog: Catalog, offset_s: int = fv.IST_OFFSET_S, co_partitioned: bool = True) -> DataFrame:
    """Active installments in canonical form (see ``operators.installments``), each source row once.

    Source rows repeat.  Copies agree in every source column, so rows are compared as they arrive, before seconds become days;
    where the source has an ``id``, it and the columns that are used tell rows apart, otherwise all columns do.  Copies are
    removed inside the (loan, due month) partitioning that the aggregates of ``operators`` go on with, so the rows are moved once.
    ``co_partitioned=False`` removes them under a partitioning by the whole row instead: one more movement of aggregated rows,
    but a single (loan, month) that holds a large share of all rows is spread.  Money must have two decimals at most;
    finer amounts are an error, not rounded.
    """
    raw = catalog.table("installments").filter(F.col("deleted") == "N")
    used = ("loan_id", "uid_l", "due_date", "created", "udated", "emi_state", "amount", "principal", "interest")
    if "id" in raw.columns:
        raw = raw.select("id", *used)
    due = epoch_to_local_date("due_date", offset_s)
    keys = {"__loan": F.col("loan_id").try_cast("long"), "__month": F.trunc(due, "month")}
    rows = raw.withColumns(keys)
    if co_partitioned:
        rows = rows.repartition(*keys)
    # The money columns take part as they came; only then are they read.
    return rows.distinct().select(
        F.col("__loan").alias("loan_id"), F.col("uid_l").cast("long").alias("lender"), due.alias("due"),
        epoch_to_local_date("created", offset_s).alias("created"), epoch_to_local_date("udated", offset_s).alias("updated"),
        F.col("emi_state").alias("state"), *[hundredths(m) for m in ("amount", "principal", "interest")], F.col("__month").alias("emi_month"))


def hundredths(c: str):
    """A money column with two decimals; raises where that would change an amount."""
    exact = F.col(c).cast("decimal(18,2)")
    if_finer = F.raise_error(F.lit(f"column {c} has more than two decimals"))
    return F.when(F.abs(F.col(c) - exact) > 0.000001, if_finer.cast("decimal(18,2)")).otherwise(exact).alias(c)
