"""KPI marts: daily, monthly, industry heatmap, merchant cohorts, top merchants,
decline drivers.

Daily / monthly outputs have one row per calendar day / month, so their
order-by windows run over a bounded number of rows after the aggregate.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.joins import dimension_side, rollup_through_dimension
from ..operators.ranking import dense_rank_by_value
from ..sources.fixtures import Tables


def kpi_daily(t: Tables) -> DataFrame:
    daily = t.transactions.groupBy(F.col("txn_date").alias("day")).agg(
        X.gpv_sum().alias("gpv"),
        F.count(F.lit(1)).alias("txns"),
        X.count_when(X.APPROVED).alias("approved_txns"),
        X.money_sum("amount").alias("amount_total"),
        F.count("amount").alias("amount_n"),
        X.fee_sum().alias("total_fees"),
    )
    return daily.select(
        "day",
        F.coalesce(F.col("gpv"), F.lit(0)).cast("double").alias("gpv"),
        "txns",
        X.safe_div("approved_txns", "txns").alias("approval_rate"),
        X.mean_from_sums("amount_total", "amount_n").alias("avg_amount"),
        X.as_double("total_fees").alias("total_fees"),
    )


def kpi_monthly(t: Tables) -> DataFrame:
    monthly = t.transactions.groupBy(X.month_start("txn_date").alias("month")).agg(
        X.gpv_sum().alias("gpv"),
        F.count(F.lit(1)).alias("txns"),
        X.count_when(X.APPROVED).alias("approved_txns"),
    )
    by_month = Window.orderBy("month")  # one row per calendar month
    return monthly.select(
        "month",
        X.as_double("gpv").alias("gpv"),
        "txns",
        X.safe_div("approved_txns", "txns").alias("approval_rate"),
        X.growth("gpv", F.lag("gpv").over(by_month)).alias("mom_growth"),
    )


def _yearly_region_industry(t: Tables) -> DataFrame:
    return rollup_through_dimension(
        t, t.transactions.withColumnRenamed("partition_year", "metric_year"), "merchants", "merchant_id",
        ["metric_year"], ["region", "industry"],
        {"gpv": X.gpv_sum(), "approved_txns": X.count_when(X.APPROVED), "txns": F.count(F.lit(1))},
    )


def industry_heatmap(t: Tables) -> DataFrame:
    """Each region x industry pair at its own latest year, with growth vs its previous row."""
    yearly = _yearly_region_industry(t)
    pair = Window.partitionBy("region", "industry")
    scored = yearly.select(
        "region", "industry", "metric_year", "gpv",
        X.safe_div("approved_txns", "txns").alias("approval_rate"),
        F.lag("gpv").over(pair.orderBy("metric_year")).alias("prev_gpv"),
        F.row_number().over(pair.orderBy(F.col("metric_year").desc())).alias("row_rank"),
    )
    return scored.where("row_rank = 1").select(
        "region", "industry", X.as_double("gpv").alias("gpv"), "approval_rate",
        X.growth("gpv", "prev_gpv").alias("yoy_growth"),
    )


def merchant_cohort_activity(t: Tables, attributes: tuple[str, ...] = ()) -> DataFrame:
    """(signup_month, month_index, merchant_id) and attributes of the merchant for approved activity on or after signup.

    (merchant, activity month) is made distinct before the join, so each
    merchant appears once per cell and a plain count is a distinct count.
    """
    activity = (t.transactions.where(X.APPROVED)
                .select("merchant_id", X.month_start("txn_date").alias("activity_month")).distinct())
    cohort = t.merchants.select("merchant_id", X.month_start("signup_date").alias("signup_month"), *attributes)
    joined = activity.join(dimension_side(t, "merchants", cohort), "merchant_id").where(F.col("activity_month") >= F.col("signup_month"))
    return joined.select("signup_month", "activity_month", "merchant_id", *attributes,
                         X.month_boundaries_between("signup_month", "activity_month").alias("month_index"))


def merchant_cohort_sizes(t: Tables) -> DataFrame:
    return (t.merchants.groupBy(X.month_start("signup_date").alias("signup_month"))
            .agg(F.count(F.lit(1)).alias("cohort_merchants")))


def merchant_cohorts(t: Tables) -> DataFrame:
    cells = merchant_cohort_activity(t).groupBy("signup_month", "month_index").agg(
        F.count(F.lit(1)).alias("retained_merchants"))
    sizes = merchant_cohort_sizes(t)  # one row per signup month: bounded by the calendar
    return cells.join(F.broadcast(sizes), "signup_month").select(
        "signup_month", "month_index", "retained_merchants",
        X.safe_div("retained_merchants", "cohort_merchants").alias("retention_rate"),
    )


def merchant_performance(t: Tables) -> DataFrame:
    """Per merchant with at least one transaction: gpv (NULL if none approved), txns."""
    per_merchant = t.transactions.groupBy("merchant_id").agg(
        X.gpv_sum().alias("gpv"), F.count(F.lit(1)).alias("txns"))
    dim = t.merchants.select("merchant_id", "industry", "region")
    return per_merchant.join(dimension_side(t, "merchants", dim), "merchant_id")


def top_merchants(t: Tables) -> DataFrame:
    perf = merchant_performance(t).withColumn("gpv", X.as_double("gpv"))
    return dense_rank_by_value(perf, "gpv", "gpv_rank").select(
        "merchant_id", "industry", "region", "gpv", "txns", "gpv_rank")


def decline_drivers(t: Tables) -> DataFrame:
    fact = t.transactions.withColumn("decline_reason", F.coalesce("decline_reason", F.lit("unknown")))
    base = rollup_through_dimension(
        t, fact, "merchants", "merchant_id", ["decline_reason", "channel"], ["industry"],
        {"declined_txns": X.count_unless(X.APPROVED), "total_txns": F.count(F.lit(1))},
    )
    return base.select("decline_reason", "channel", "industry",
                       X.safe_div("declined_txns", "total_txns").alias("decline_rate"))


#: Columns of the fact that the marts read.
FACT_COLUMNS = ["txn_date", "merchant_id", "amount", "approved", "decline_reason", "fee", "channel", "partition_year"]
MARTS = {
    "kpi_daily": kpi_daily,
    "kpi_monthly": kpi_monthly,
    "industry_heatmap": industry_heatmap,
    "merchant_cohorts": merchant_cohorts,
    "top_merchants": top_merchants,
    "decline_drivers": decline_drivers,
}
