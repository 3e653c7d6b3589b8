"""The eight analysis queries as SQL over the catalog tables, in pipe syntax."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.catalog import DATABASE

APPROVED_VOLUME = "SUM(amount) FILTER (WHERE approved)"
METHOD_WEEK = "PARTITION BY channel, payment_method ORDER BY txn_date ROWS 6 PRECEDING"
REGION_WEEK = "PARTITION BY region ORDER BY txn_date ROWS 6 PRECEDING"

SQL = {
    "channel_heatmap": f"""
        FROM {{db}}.transactions JOIN {{db}}.merchants USING (merchant_id)
        |> AGGREGATE CAST({APPROVED_VOLUME} AS DOUBLE) AS gpv GROUP BY region, channel, partition_year AS metric_year
        |> EXTEND LAG(gpv) OVER (PARTITION BY region, channel ORDER BY metric_year) AS year_before
        |> SELECT region, channel, metric_year, gpv, try_divide(gpv - year_before, NULLIF(year_before, 0)) AS yoy_growth
        |> ORDER BY region NULLS LAST, channel NULLS LAST, metric_year""",
    "customer_segment_retention": """
        FROM {db}.transactions
        |> WHERE approved
        |> AGGREGATE GROUP BY customer_id, trunc(txn_date, 'month') AS seen
        |> JOIN (FROM {db}.customers
                 |> SELECT customer_id, segment, trunc(join_date, 'month') AS join_month,
                           COUNT(*) OVER (PARTITION BY segment, trunc(join_date, 'month')) AS customers) USING (customer_id)
        |> WHERE seen >= join_month
        |> AGGREGATE COUNT(*) AS retained_customers, MAX(customers) AS customers
           GROUP BY segment, join_month, (year(seen) - year(join_month)) * 12 + month(seen) - month(join_month) AS month_index
        |> SELECT segment, join_month, month_index, retained_customers,
                  CAST(retained_customers AS DOUBLE) / CAST(customers AS DOUBLE) AS retention_rate
        |> ORDER BY segment NULLS LAST, join_month, month_index""",
    "fee_take_rate_trend": f"""
        FROM {{db}}.transactions
        |> AGGREGATE CAST(SUM(fee) AS DOUBLE) AS total_fees, CAST({APPROVED_VOLUME} AS DOUBLE) AS approved_volume GROUP BY txn_date
        |> EXTEND try_divide(total_fees, approved_volume) AS take_rate
        |> EXTEND ROUND(AVG(take_rate) OVER (ORDER BY txn_date ROWS 13 PRECEDING), 10) AS take_rate_14d
        |> ORDER BY txn_date""",
    "industry_region_declines": """
        FROM {db}.transactions JOIN {db}.merchants USING (merchant_id)
        |> AGGREGATE COUNT(*) - COUNT_IF(approved) AS declined_txns, COUNT(*) AS total_txns GROUP BY industry, region
        |> EXTEND CAST(declined_txns AS DOUBLE) / total_txns AS decline_rate
        |> EXTEND CAST(RANK() OVER (ORDER BY declined_txns DESC) AS BIGINT) AS decline_rank
        |> ORDER BY decline_rank""",
    "payment_method_mix": f"""
        FROM {{db}}.transactions
        |> AGGREGATE {APPROVED_VOLUME} AS volume GROUP BY txn_date, channel, payment_method
        |> EXTEND SUM(volume) OVER (PARTITION BY txn_date, channel) AS of_channel,
                  SUM(volume) OVER ({METHOD_WEEK}) AS week, COUNT(volume) OVER ({METHOD_WEEK}) AS days
        |> SELECT txn_date, channel, payment_method, CAST(volume AS DOUBLE) AS gpv,
                  try_divide(CAST(volume AS DOUBLE), CAST(of_channel AS DOUBLE)) AS share,
                  try_divide(CAST(week AS DOUBLE), CAST(days AS DOUBLE)) AS gpv_7d
        |> ORDER BY txn_date, channel NULLS LAST, gpv DESC NULLS LAST""",
    "region_volume_volatility": f"""
        FROM {{db}}.transactions JOIN {{db}}.merchants USING (merchant_id)
        |> AGGREGATE {APPROVED_VOLUME} AS volume GROUP BY region, txn_date
        |> EXTEND SUM(volume) OVER ({REGION_WEEK}) AS week, COUNT(volume) OVER ({REGION_WEEK}) AS days,
                  STDDEV(CAST(volume AS DOUBLE)) OVER ({REGION_WEEK}) AS spread
        |> SELECT region, txn_date, CAST(volume AS DOUBLE) AS gpv, try_divide(CAST(week AS DOUBLE), CAST(days AS DOUBLE)) AS gpv_avg_7d,
                  ROUND(spread, 4) AS gpv_stddev_7d
        |> ORDER BY region NULLS LAST, txn_date""",
    "rolling_approval_rate": """
        FROM {db}.transactions
        |> AGGREGATE CAST(COUNT_IF(approved) AS DOUBLE) / COUNT(*) AS daily_approval GROUP BY txn_date
        |> EXTEND ROUND(AVG(daily_approval) OVER (ORDER BY txn_date ROWS 6 PRECEDING), 10) AS approval_rate_7d
        |> ORDER BY txn_date""",
    "top_mom_movers": f"""
        WITH steps AS (
            FROM {{db}}.transactions
            |> AGGREGATE CAST({APPROVED_VOLUME} AS DOUBLE) AS gpv GROUP BY merchant_id, trunc(txn_date, 'month') AS month
            |> EXTEND LAG(gpv) OVER (PARTITION BY merchant_id ORDER BY month) AS prev_gpv
            |> EXTEND try_divide(gpv - prev_gpv, NULLIF(prev_gpv, 0)) AS mom_growth)
        FROM steps
        |> WHERE ABS(mom_growth) = (SELECT MAX(ABS(mom_growth)) FROM steps)
        |> ORDER BY ABS(mom_growth) DESC""",
}


def run(spark: SparkSession, name: str, database: str = DATABASE) -> DataFrame:
    """An analysis query by its SQL text."""
    return spark.sql(SQL[name].format(db=database))
