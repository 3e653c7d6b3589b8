"""Snapshot summary and data-quality checks.

Every check is one Spark aggregate ending in one row (or one row per check);
only ``enforce`` looks at the (bounded) report on the driver and raises.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.joins import dimension_side, rollup_through_dimension
from ..operators.keysets import dense, missing_keys
from ..sources.fixtures import Tables


def run_summary(t: Tables) -> DataFrame:
    """One row: dimension and fact row counts, date range, approval rate."""
    n_merchants = t.merchants.agg(F.count(F.lit(1))).scalar()
    n_customers = t.customers.agg(F.count(F.lit(1))).scalar()
    stats = t.transactions.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.to_date(F.min("ts")).alias("start_date"),
        F.to_date(F.max("ts")).alias("end_date"),
        X.count_when(X.APPROVED).alias("_approved"),
    )
    return stats.select(
        n_merchants.alias("merchants"), n_customers.alias("customers"), "transactions",
        "start_date", "end_date", X.safe_div("_approved", "transactions").alias("approval_rate"))


def industry_gpv(t: Tables) -> DataFrame:
    return rollup_through_dimension(
        t, t.transactions.where(X.APPROVED), "merchants", "merchant_id", [], ["industry"],
        {"gpv": X.money_sum("amount")}).select("industry", X.as_double("gpv").alias("gpv"))


def top_industries_by_gpv(t: Tables, k: int = 5) -> DataFrame:
    """Top-k industries by approved amount (the limit is the feature)."""
    return industry_gpv(t).orderBy(F.col("gpv").desc_nulls_last(), "industry").limit(k)


def _null_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.agg(*[X.count_when(F.col(c).isNull()).alias(out) for c, out in columns.items()])


def dq_nulls_merchants(t: Tables) -> DataFrame:
    return _null_counts(t.merchants, DIMENSION_CHECKS["merchants"])


def dq_nulls_customers(t: Tables) -> DataFrame:
    return _null_counts(t.customers, DIMENSION_CHECKS["customers"])


def dq_nulls_transactions(t: Tables) -> DataFrame:
    return _null_counts(t.transactions, FACT_CHECKS)


def _range_counts() -> list:
    # NOT IN over a NULL boolean yields NULL, never TRUE: the last check cannot fire.
    return [X.count_when(F.col("amount") <= 0).alias("invalid_amounts"), X.count_when(F.col("fee") < 0).alias("invalid_fees"),
            X.count_when(~F.col("approved").isin(True, False)).alias("invalid_approved")]


def dq_range_checks(t: Tables) -> DataFrame:
    return t.transactions.agg(*_range_counts())


#: Check -> dimension and key of the fact.
REFERENCES = {"missing_merchants": ("merchants", "merchant_id"), "missing_customers": ("customers", "customer_id")}


def orphans(t: Tables, checks) -> DataFrame:
    """One row: different keys of the fact without a dimension row, for each check. Dense keys meet as bitmaps,
    so no fact row is shuffled; others as distinct keys in an anti join."""
    dims = {check: (t.table(REFERENCES[check][0]).select(REFERENCES[check][1]), REFERENCES[check][1]) for check in checks}
    close = dense(dims)
    parts = [missing_keys(t.transactions, {c: dims[c] for c in checks if c in close})] if close else []
    for check in (c for c in checks if c not in close):
        dim, key = dims[check]
        keys = t.transactions.select(key).distinct()  # partial dedupe map-side before the shuffle
        parts.append(keys.join(dimension_side(t, REFERENCES[check][0], dim), key, "left_anti").agg(F.count(F.lit(1)).alias(check)))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.agg(*[F.max(check).alias(check) for check in checks])


def dq_fk_merchant(t: Tables) -> DataFrame:
    return orphans(t, ["missing_merchants"])


def dq_fk_customer(t: Tables) -> DataFrame:
    return orphans(t, ["missing_customers"])


PRIMARY_KEYS = {"merchants": "merchant_id", "customers": "customer_id", "transactions": "txn_id"}


def dq_pk_duplicates(t: Tables) -> DataFrame:
    """Per table: keys occurring more than once and the rows carrying them."""
    parts = []
    for table, key in PRIMARY_KEYS.items():
        dup = (t.table(table).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
               .agg(X.count_when(F.col("n") > 1).alias("duplicate_keys"),
                    F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint")
                    .alias("duplicate_rows")))
        parts.append(dup.select(F.lit(table).alias("table_name"), "duplicate_keys", "duplicate_rows"))
    return reduce(DataFrame.unionByName, parts)


def _as_rows(one_row: DataFrame, table: str) -> DataFrame:
    cols = one_row.columns
    return one_row.unpivot([], cols, "check_name", "violations").select(
        F.lit(table).alias("table_name"), "check_name", F.col("violations").cast("bigint"))


FACT_CHECKS = {"txn_id": "txn_id_nulls", "ts": "ts_nulls", "merchant_id": "merchant_nulls",
               "customer_id": "customer_nulls", "amount": "amount_nulls", "approved": "approved_nulls"}
DIMENSION_CHECKS = {"merchants": {"merchant_id": "merchant_id_nulls", "industry": "industry_nulls", "region": "region_nulls"},
                    "customers": {"customer_id": "customer_id_nulls", "segment": "segment_nulls", "region": "region_nulls"}}


def row_checks(table: str) -> list:
    """The null and range checks of a table as aggregates, for a query or for an Observation of a write."""
    nulls = FACT_CHECKS if table == "transactions" else DIMENSION_CHECKS[table]
    return [X.count_when(F.col(c).isNull()).alias(out) for c, out in nulls.items()] + (_range_counts() if table == "transactions" else [])


def _finished(report: DataFrame) -> DataFrame:
    return report.withColumn("violations", F.coalesce("violations", F.lit(0).cast("bigint"))).withColumn("passed", F.col("violations") == 0)


def key_report(t: Tables) -> DataFrame:
    """Orphans and repeated keys as rows. Orphans meet as bitmaps, so of the fact only txn_id is shuffled."""
    duplicates = dq_pk_duplicates(t).select("table_name", F.lit("duplicate_keys").alias("check_name"), F.col("duplicate_keys").alias("violations"))
    return _as_rows(orphans(t, list(REFERENCES)), "transactions").unionByName(duplicates)


def dq_report(t: Tables) -> DataFrame:
    """All checks as rows: table_name, check_name, violations, passed."""
    rows = [_as_rows(t.table(name).agg(*row_checks(name)), name) for name in (*DIMENSION_CHECKS, "transactions")]
    return _finished(reduce(DataFrame.unionByName, rows).unionByName(key_report(t)))


def observed_report(t: Tables, observed: dict[str, dict]) -> DataFrame:
    """``dq_report`` with the null and range checks that were counted while the tables were written."""
    rows = [(name, check, int(n or 0)) for name, values in observed.items() for check, n in values.items() if check != "rows"]
    counted = t.spark.createDataFrame(rows, "table_name string, check_name string, violations bigint")
    return _finished(counted.unionByName(key_report(t)))


class QualityError(ValueError):
    pass


def enforce(t: Tables, include_primary_keys: bool = False, observed: dict[str, dict] | None = None) -> DataFrame:
    """Run the gate: raise on any violation. The report has one row per check; what was ``observed`` while
    the tables were written is not read again."""
    report = dq_report(t) if observed is None else observed_report(t, observed)
    if not include_primary_keys:
        report = report.where(F.col("check_name") != "duplicate_keys")
    failed = [r.asDict() for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise QualityError(f"data quality checks failed: {failed}")
    return report


QUERIES = {
    "run_summary": run_summary,
    "top_industries_by_gpv": top_industries_by_gpv,
    "dq_nulls_merchants": dq_nulls_merchants,
    "dq_nulls_customers": dq_nulls_customers,
    "dq_nulls_transactions": dq_nulls_transactions,
    "dq_range_checks": dq_range_checks,
    "dq_fk_merchant": dq_fk_merchant,
    "dq_fk_customer": dq_fk_customer,
    "dq_pk_duplicates": dq_pk_duplicates,
    "dq_report": dq_report,
}
