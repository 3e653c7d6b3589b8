"""Typed loads, partitioned round trip, row counts and mart export."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import materialize
from ..session import shared_work_dir
from ..sources import footers, schemas
from ..sources import warehouse as W
from ..sources.fixtures import Tables
from . import kpis, quality


def _reference_types(df: DataFrame) -> DataFrame:
    """The warehouse DDL stores money as DOUBLE."""
    out = df
    for c in ("amount", "fee"):
        if c in df.columns:
            out = out.withColumn(c, F.col(c).cast("double"))
    return out


def load_transactions(t: Tables) -> DataFrame:
    return _reference_types(W.typed(t.transactions, schemas.TRANSACTIONS))


def load_merchants(t: Tables) -> DataFrame:
    return W.typed(t.merchants, schemas.MERCHANTS)


def load_customers(t: Tables) -> DataFrame:
    return W.typed(t.customers, schemas.CUSTOMERS)


def scan_partitioned(t: Tables) -> DataFrame:
    """Write the fact as year=/month= partitions, read it back with partition
    discovery and count rows per partition."""
    path = shared_work_dir(t.spark, "txn-layout")
    W.write_year_month_layout(W.typed(t.transactions, schemas.TRANSACTIONS), path)
    back = W.read_year_month_layout(t.spark, path)
    return back.groupBy(F.col("partition_year").alias("year"), F.col("partition_month").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"))


def payments_layout(t: Tables) -> DataFrame:
    """Write the raw payments layout (dimension files and a year=/month= tree of the fact
    without its derived columns) and load the fact from it."""
    base = shared_work_dir(t.spark, "payments")
    W.typed(t.merchants, schemas.MERCHANTS).write.mode("overwrite").parquet(f"{base}/merchants.parquet")
    W.typed(t.customers, schemas.CUSTOMERS).write.mode("overwrite").parquet(f"{base}/customers.parquet")
    W.write_year_month_layout(W.typed(t.transactions, schemas.TRANSACTIONS).drop("txn_date"), f"{base}/transactions")
    return load_transactions(Tables.from_payments(t.spark, base))


TABLES = ("merchants", "customers", "transactions")


def table_row_counts(t: Tables) -> DataFrame:
    """Rows of each table; of a loaded warehouse from the footers of its files."""
    if t.folder:
        return t.spark.createDataFrame([(n, footers.row_count(t.spark, f"{t.folder}/{n}")) for n in TABLES], "table_name string, rows bigint")
    parts = [t.table(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in TABLES]
    return reduce(DataFrame.unionByName, parts)


def loaded_row_counts(t: Tables) -> DataFrame:
    """Load the warehouse, and the rows of its tables by their footers."""
    return table_row_counts(W.load_warehouse(t, shared_work_dir(t.spark, "warehouse")))


def export_marts(t: Tables, base: str) -> dict[str, int]:
    """Write each KPI mart as CSV with a header (overwrite) under its name; mart -> rows, counted by the write jobs.

    All marts read one fact: of a loaded warehouse its files, else the derived rows, written once.
    """
    if not t.folder:
        t = t.replace(transactions=materialize(t.transactions.select(*kpis.FACT_COLUMNS), "marts-fact"))
    return {name: W.export_csv(fn(t), f"{base.rstrip('/')}/{name}") for name, fn in kpis.MARTS.items()}


def mart_export_counts(t: Tables) -> DataFrame:
    """Export the six marts as CSV: the rows written per mart."""
    counts = export_marts(t, shared_work_dir(t.spark, "marts"))
    return t.spark.createDataFrame(list(counts.items()), "mart string, rows bigint")


def load_checks(t: Tables) -> DataFrame:
    """Load the warehouse, its null and range checks counted by the write jobs: table_name, check_name, violations, passed."""
    observed: dict[str, dict] = {}
    loaded = W.load_warehouse(t, shared_work_dir(t.spark, "warehouse"), checks=quality.row_checks, observed=observed)
    return quality.observed_report(loaded, observed)


QUERIES = {
    "load_transactions": load_transactions,
    "payments_layout": payments_layout,
    "load_merchants": load_merchants,
    "load_customers": load_customers,
    "scan_partitioned": scan_partitioned,
    "table_row_counts": table_row_counts,
    "loaded_row_counts": loaded_row_counts,
    "mart_export_counts": mart_export_counts,
    "load_checks": load_checks,
}
