"""Merchant-week features, the weekly spine and forward-looking labels.

Plan shape (one fact scan, two shuffles for everything):

1. features: the few columns used of each transaction are hash-partitioned by
   merchant and week; the day and the week aggregate both run on that exchange.
   A hot merchant is spread over its weeks.
2. labels: merchant x day partial sums are hash-partitioned on merchant_id; the
   week aggregate, the spine and the label windows reuse that exchange.

Money is summed as exact integer cents (bigint; fees as micro-units), which
keeps every sum exact and order-independent while running on primitive longs
(decimal sums widen past 18 digits and fall back to BigDecimal). Sums of
squares, which can exceed a long, stay decimal. The 60 % revenue test compares
integers: 10 x future <= 6 x trailing.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..sources.fixtures import Tables

HORIZON = 4
DECLINE_RATIO = "0.6"
RATIO_NUM, RATIO_DEN = 6, 10  # DECLINE_RATIO as an exact fraction

COUNT_FEATURES = ["txns", "approved_txns", "decline_txns", "active_days"]
DOUBLE_FEATURES = ["gpv", "avg_amount", "total_fees", "amount_volatility", "gpv_volatility", "decline_rate",
                   "txn_frequency", "fee_yield", "share_card", "share_ach", "share_wallet", "share_pos",
                   "share_ecom", "share_inapp"]
CALENDAR = ["month", "week_of_year"]
FEATURE_COLUMNS = ["merchant_id", "week_start_date"] + COUNT_FEATURES[:3] + ["gpv", "avg_amount", "total_fees",
                                                                            "active_days"] + DOUBLE_FEATURES[3:]
LABELS = ["churn_4w", "rev_decline_40pct"]
ID_COLUMNS = ["merchant_id", "week_start_date"]
VOLATILITY_DIGITS = 6


def merchant_days(t: Tables, for_windows: bool = False) -> DataFrame:
    """Exact per merchant-day sums, hash-partitioned by merchant and week (``for_windows``: by merchant)."""
    ok, week = X.APPROVED, X.week_start("txn_date")
    tx = t.transactions.select(
        "merchant_id", week.alias("week_start_date"), "txn_date", ok.alias("ok"), "payment_method", "channel",
        (F.col("amount") * 100).cast("bigint").alias("cents"), (F.col("fee") * 1000000).cast("bigint").alias("micros"))
    if not for_windows:
        # The one exchange of the fact: by merchant and week, which serves the day and the week
        # aggregate. The rows of a hot merchant are spread over its weeks.
        tx = tx.repartition("merchant_id", "week_start_date")
    cents, zero = F.col("cents"), F.lit(0).cast("bigint")

    def approved_cents(cond=None):
        c = F.col("ok") if cond is None else (F.col("ok") & cond)
        return F.sum(F.when(c, cents).otherwise(zero))

    days = tx.groupBy("merchant_id", "week_start_date", "txn_date").agg(
        F.count(F.lit(1)).alias("txns"),
        X.count_when(F.col("ok")).alias("approved_txns"),
        X.count_when(~F.col("ok")).alias("decline_txns"),
        approved_cents().alias("gpv"),
        F.sum(cents).alias("amount_sum"),
        F.count(cents).alias("amount_n"),
        F.sum(cents.cast("decimal(20,0)") * cents.cast("decimal(20,0)")).alias("amount_sq"),
        F.sum(F.when(F.col("ok"), F.col("micros")).otherwise(zero)).alias("total_fees"),
        approved_cents(F.col("payment_method") == "card").alias("card_gpv"),
        approved_cents(F.col("payment_method") == "ach").alias("ach_gpv"),
        approved_cents(F.col("payment_method") == "wallet").alias("wallet_gpv"),
        approved_cents(F.col("channel") == "pos").alias("pos_gpv"),
        approved_cents(F.col("channel") == "ecom").alias("ecom_gpv"),
        approved_cents(F.col("channel").isin("in_app", "inapp")).alias("inapp_gpv"),
    )
    # Windows by merchant reuse this exchange; it fixes the order of the training rows, on which models depend.
    return days.repartition("merchant_id") if for_windows else days


def _weeks_exact(t: Tables, for_windows: bool = False) -> DataFrame:
    days = merchant_days(t, for_windows)
    sums = ["txns", "approved_txns", "decline_txns", "gpv", "amount_sum", "amount_n", "amount_sq", "total_fees",
            "card_gpv", "ach_gpv", "wallet_gpv", "pos_gpv", "ecom_gpv", "inapp_gpv"]
    day_gpv = F.col("gpv").cast("decimal(38,0)")
    return days.groupBy("merchant_id", "week_start_date").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count(F.lit(1)).alias("active_days"),
        F.sum(day_gpv * day_gpv).alias("gpv_sq"),
    )


def _dollars(cents) -> F.Column:
    return X.as_double(cents) / F.lit(100.0)


def _volatility(n, s1, s2) -> F.Column:
    """Population stddev in dollars from cent sums (0 when undefined), rounded."""
    std_cents = X.pop_stddev_from_sums(n, F.col(s1).cast("decimal(38,0)"), s2)
    return F.round(F.coalesce(std_cents / F.lit(100.0), F.lit(0.0)), VOLATILITY_DIGITS)


def _feature_columns(w: DataFrame) -> DataFrame:
    gpv = F.col("gpv")
    # ratios divide dollar values (cents / 100 is the correctly rounded dollar double)
    share = lambda c: F.when(gpv > 0, _dollars(c) / _dollars(gpv)).otherwise(F.lit(0.0))
    fees_dollars = X.as_double("total_fees") / F.lit(1000000.0)
    return w.select(
        "merchant_id", "week_start_date",
        F.col("txns").cast("bigint").alias("txns"),
        F.col("approved_txns").cast("bigint").alias("approved_txns"),
        F.col("decline_txns").cast("bigint").alias("decline_txns"),
        _dollars("gpv").alias("gpv"),
        F.when(F.col("amount_n") > 0, _dollars("amount_sum") / X.as_double("amount_n")).alias("avg_amount"),
        fees_dollars.alias("total_fees"),
        F.col("active_days").cast("bigint").alias("active_days"),
        _volatility("amount_n", "amount_sum", "amount_sq").alias("amount_volatility"),
        _volatility("active_days", "gpv", "gpv_sq").alias("gpv_volatility"),
        X.ratio_or_zero("decline_txns", "txns").alias("decline_rate"),
        X.ratio_or_zero("txns", "active_days").alias("txn_frequency"),
        F.when(gpv > 0, fees_dollars / _dollars("gpv")).otherwise(F.lit(0.0)).alias("fee_yield"),
        share("card_gpv").alias("share_card"),
        share("ach_gpv").alias("share_ach"),
        share("wallet_gpv").alias("share_wallet"),
        share("pos_gpv").alias("share_pos"),
        share("ecom_gpv").alias("share_ecom"),
        share("inapp_gpv").alias("share_inapp"),
        F.col("gpv").alias("_gpv_exact"),
    )


def _calendar(df: DataFrame) -> DataFrame:
    return (df.withColumn("month", F.month("week_start_date").cast("int"))
            .withColumn("week_of_year", F.weekofyear("week_start_date").cast("int")))


def features_exact(t: Tables, for_windows: bool = False) -> DataFrame:
    """Features plus the exact decimal gpv (``_gpv_exact``) used by the labels."""
    return _calendar(_feature_columns(_weeks_exact(t, for_windows)))


def merchant_week_features(t: Tables) -> DataFrame:
    return features_exact(t).drop("_gpv_exact")


def gpv_volatility(t: Tables) -> DataFrame:
    """Population stddev of per-day approved gpv inside each merchant week."""
    w = _weeks_exact(t)
    return w.select("merchant_id", "week_start_date", _volatility("active_days", "gpv", "gpv_sq").alias("gpv_volatility"))


def weekly_grid_exact(t: Tables) -> DataFrame:
    """Each merchant's weeks from its first to its last active week, gaps zero-filled.

    Gap rows are generated from each row and the next active week (a window
    partitioned by merchant), so no spine join is needed and the frame keeps
    its merchant partitioning for the label windows.
    """
    return grid_of(features_exact(t, for_windows=True))


def grid_of(f: DataFrame) -> DataFrame:
    """``weekly_grid_exact`` from feature rows."""
    by_merchant = Window.partitionBy("merchant_id").orderBy("week_start_date")
    f = f.withColumn("_next", F.lead("week_start_date").over(by_merchant))
    last_week = F.coalesce(F.date_sub("_next", 7), F.col("week_start_date"))
    f = f.withColumn("_gen", F.explode(F.sequence(F.col("week_start_date"), last_week, F.expr("INTERVAL 7 DAYS"))))
    real = F.col("_gen") == F.col("week_start_date")
    out = [F.col("merchant_id"), F.col("_gen").alias("week_start_date")]
    for c in COUNT_FEATURES:
        out.append(F.when(real, F.col(c)).otherwise(F.lit(0).cast("bigint")).alias(c))
    for c in DOUBLE_FEATURES:
        out.append(F.when(real, F.col(c)).otherwise(F.lit(0.0)).alias(c))
    out.append(F.when(real, F.col("_gpv_exact")).otherwise(F.lit(0).cast("bigint")).alias("_gpv_exact"))
    grid = f.select(*out)
    return _calendar(grid).select(*FEATURE_COLUMNS, *CALENDAR, "_gpv_exact")


def weekly_grid(t: Tables) -> DataFrame:
    return weekly_grid_exact(t).drop("_gpv_exact")


def with_labels(grid: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """churn_4w and rev_decline_40pct over each merchant's contiguous weekly rows.

    churn: NULL unless ``horizon`` later rows exist; 1 when their approved
    transactions sum to 0. revenue decline: NULL unless the later rows exist
    and a full trailing window (current row included) has positive gpv; 1 when
    future gpv <= 0.6 x trailing gpv (exact decimal comparison).
    """
    w = Window.partitionBy("merchant_id").orderBy("week_start_date")
    ahead = w.rowsBetween(1, horizon)
    behind = w.rowsBetween(-(horizon - 1), 0)
    future_rows = F.count(F.lit(1)).over(ahead)
    future_ok = future_rows == horizon
    future_approved = F.sum("approved_txns").over(ahead)
    churn = F.when(future_ok, F.when(future_approved == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    past_rows = F.count(F.lit(1)).over(behind)
    past = F.sum("_gpv_exact").over(behind)
    future = F.sum("_gpv_exact").over(ahead)
    valid = future_ok & (past_rows == horizon) & (past > 0)
    decline = F.when(valid, F.when(future * RATIO_DEN <= past * RATIO_NUM, F.lit(1.0)).otherwise(F.lit(0.0)))
    return grid.withColumn("churn_4w", churn).withColumn("rev_decline_40pct", decline)


def training_table_exact(t: Tables) -> DataFrame:
    return with_labels(weekly_grid_exact(t))


def training_table(t: Tables) -> DataFrame:
    return training_table_exact(t).drop("_gpv_exact")


def training_table_from(features: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The training table from a saved feature table. Over one bucketed by merchant no row is exchanged.

    The exact volume of a week is its gpv in cents: the double nearest to a number of cents gives it back.
    """
    cents = F.round(F.col("gpv") * 100).cast("bigint")
    return with_labels(grid_of(features.withColumn("_gpv_exact", cents)), horizon).drop("_gpv_exact")


def churn_label(t: Tables) -> DataFrame:
    return training_table(t).select("merchant_id", "week_start_date", "churn_4w")


def rev_decline_label(t: Tables) -> DataFrame:
    return training_table(t).select("merchant_id", "week_start_date", "rev_decline_40pct")


QUERIES = {
    "merchant_week_features": merchant_week_features,
    "gpv_volatility": gpv_volatility,
    "weekly_grid": weekly_grid,
    "churn_label": churn_label,
    "rev_decline_label": rev_decline_label,
    "training_table": training_table,
}
