"""Window-heavy analysis queries over the payments fact.

Windows ordered by day or month run after an aggregate whose row count is
bounded by the calendar (times a handful of channels / methods / regions),
so even the unpartitioned ones stay small at any data volume. Rolling
frames count rows, not calendar days, so a missing day stretches a frame.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.joins import dimension_side, rollup_through_dimension
from ..operators.lineage import materialize
from ..sources.fixtures import Tables


def channel_heatmap(t: Tables) -> DataFrame:
    yearly = rollup_through_dimension(
        t, t.transactions.withColumnRenamed("partition_year", "metric_year"), "merchants", "merchant_id",
        ["channel", "metric_year"], ["region"], {"gpv": X.gpv_sum()})
    w = Window.partitionBy("region", "channel").orderBy("metric_year")
    return yearly.select(
        "region", "channel", "metric_year", X.as_double("gpv").alias("gpv"),
        X.growth("gpv", F.lag("gpv").over(w)).alias("yoy_growth"))


def customer_cohort_activity(t: Tables) -> DataFrame:
    """(segment, join_month, month_index, customer_id), one row per customer per cell."""
    activity = (t.transactions.where(X.APPROVED)
                .select("customer_id", X.month_start("txn_date").alias("activity_month")).distinct())
    cohort = t.customers.select("customer_id", "segment", X.month_start("join_date").alias("join_month"))
    joined = activity.join(dimension_side(t, "customers", cohort), "customer_id").where(F.col("activity_month") >= F.col("join_month"))
    return joined.select("segment", "join_month", "activity_month", "customer_id",
                         X.month_boundaries_between("join_month", "activity_month").alias("month_index"))


def customer_cohort_sizes(t: Tables) -> DataFrame:
    return (t.customers.groupBy("segment", X.month_start("join_date").alias("join_month"))
            .agg(F.count(F.lit(1)).alias("customers")))


def customer_segment_retention(t: Tables) -> DataFrame:
    cells = customer_cohort_activity(t).groupBy("segment", "join_month", "month_index").agg(
        F.count(F.lit(1)).alias("retained_customers"))
    sizes = customer_cohort_sizes(t)  # segments x join months: bounded by domain and calendar
    return cells.join(F.broadcast(sizes), ["segment", "join_month"]).select(
        "segment", "join_month", "month_index", "retained_customers",
        (X.as_double("retained_customers") / X.as_double("customers")).alias("retention_rate"))


def fee_take_rate_trend(t: Tables) -> DataFrame:
    daily = t.transactions.groupBy("txn_date").agg(
        X.fee_sum().alias("total_fees"), X.gpv_sum().alias("approved_volume"))
    take = X.safe_div("total_fees", "approved_volume")
    w = Window.orderBy("txn_date").rowsBetween(-13, Window.currentRow)  # one row per day
    return daily.select(
        "txn_date", X.as_double("total_fees").alias("total_fees"),
        X.as_double("approved_volume").alias("approved_volume"),
        take.alias("take_rate"),
        X.round_mean(F.avg(take).over(w)).alias("take_rate_14d"))


def industry_region_declines(t: Tables) -> DataFrame:
    base = rollup_through_dimension(
        t, t.transactions, "merchants", "merchant_id", [], ["industry", "region"],
        {"declined_txns": X.count_unless(X.APPROVED), "total_txns": F.count(F.lit(1))})
    w = Window.orderBy(F.col("declined_txns").desc())  # industry x region cells: bounded by domains
    return base.select(
        "industry", "region", "declined_txns", "total_txns",
        X.safe_div("declined_txns", "total_txns").alias("decline_rate"),
        F.rank().over(w).cast("bigint").alias("decline_rank"))


def payment_method_mix(t: Tables) -> DataFrame:
    daily = t.transactions.groupBy("txn_date", "channel", "payment_method").agg(X.gpv_sum().alias("gpv"))
    day_channel = Window.partitionBy("txn_date", "channel")
    rolling = Window.partitionBy("channel", "payment_method").orderBy("txn_date").rowsBetween(-6, 0)
    return daily.select(
        "txn_date", "channel", "payment_method", X.as_double("gpv").alias("gpv"),
        X.safe_div("gpv", F.sum("gpv").over(day_channel)).alias("share"),
        X.mean_from_sums(F.sum("gpv").over(rolling), F.count("gpv").over(rolling)).alias("gpv_7d"))


def region_volume_volatility(t: Tables) -> DataFrame:
    daily = rollup_through_dimension(
        t, t.transactions, "merchants", "merchant_id", ["txn_date"], ["region"], {"gpv": X.gpv_sum()})
    w = Window.partitionBy("region").orderBy("txn_date").rowsBetween(-6, 0)
    return daily.select(
        "region", "txn_date", X.as_double("gpv").alias("gpv"),
        X.mean_from_sums(F.sum("gpv").over(w), F.count("gpv").over(w)).alias("gpv_avg_7d"),
        F.round(F.stddev_samp(X.as_double("gpv")).over(w), 4).alias("gpv_stddev_7d"))


def rolling_approval_rate(t: Tables) -> DataFrame:
    daily = t.transactions.groupBy("txn_date").agg(
        X.count_when(X.APPROVED).alias("approved_txns"), F.count(F.lit(1)).alias("total_txns"))
    rate = X.safe_div("approved_txns", "total_txns")
    w = Window.orderBy("txn_date").rowsBetween(-6, 0)  # one row per day
    return daily.select("txn_date", rate.alias("daily_approval"),
                        X.round_mean(F.avg(rate).over(w)).alias("approval_rate_7d"))


def merchant_month_growth(t: Tables) -> DataFrame:
    """Merchant x month gpv with growth vs the merchant's previous active month."""
    return month_growth(t.transactions.groupBy("merchant_id", X.month_start("txn_date").alias("month")).agg(
        X.gpv_sum().alias("gpv")))


def month_growth(mm: DataFrame) -> DataFrame:
    """Growth of (merchant_id, month, gpv) rows."""
    w = Window.partitionBy("merchant_id").orderBy("month")  # <= one row per month per merchant
    return mm.select(
        "merchant_id", "month", X.as_double("gpv").alias("gpv"),
        X.as_double(F.lag("gpv").over(w)).alias("prev_gpv"),
    ).withColumn("mom_growth", X.growth("gpv", "prev_gpv"))


def top_mom_movers(t: Tables) -> DataFrame:
    """Merchant-month row(s) at the largest absolute growth (ties kept).

    The global maximum is an uncorrelated scalar subquery, not a window over
    all rows and not a cross join.
    """
    # merchant-month rows are written once (far fewer than fact rows) so the
    # maximum and the filter do not both rescan the fact
    deltas = materialize(merchant_month_growth(t).where(F.col("mom_growth").isNotNull()), "mom")
    top = deltas.agg(F.max(F.abs("mom_growth"))).scalar()
    return deltas.where(F.abs("mom_growth") == top)


# Presentation order of each analysis query, as (column, descending) pairs, NULLs last.
ORDER = {
    "channel_heatmap": [("region", False), ("channel", False), ("metric_year", False)],
    "customer_segment_retention": [("segment", False), ("join_month", False), ("month_index", False)],
    "fee_take_rate_trend": [("txn_date", False)],
    "industry_region_declines": [("decline_rank", False)],
    "payment_method_mix": [("txn_date", False), ("channel", False), ("gpv", True)],
    "region_volume_volatility": [("region", False), ("txn_date", False)],
    "rolling_approval_rate": [("txn_date", False)],
    "top_mom_movers": [("abs_mom_growth", True)],
}


def presentation_order(name: str) -> list:
    def key(c):
        return F.abs(F.col("mom_growth")) if c == "abs_mom_growth" else F.col(c)
    return [key(c).desc_nulls_last() if desc else key(c).asc_nulls_last() for c, desc in ORDER[name]]


def _presented(name, fn):
    def run(t: Tables) -> DataFrame:
        return fn(t).orderBy(*presentation_order(name))  # applied last, on small aggregated outputs
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {name: _presented(name, fn) for name, fn in {
    "channel_heatmap": channel_heatmap,
    "customer_segment_retention": customer_segment_retention,
    "fee_take_rate_trend": fee_take_rate_trend,
    "industry_region_declines": industry_region_declines,
    "payment_method_mix": payment_method_mix,
    "region_volume_volatility": region_volume_volatility,
    "rolling_approval_rate": rolling_approval_rate,
    "top_mom_movers": top_mom_movers,
}.items()}
