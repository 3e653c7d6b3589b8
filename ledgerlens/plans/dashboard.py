"""Dashboard and report calculations (tiles, drill-downs, cohort health,
decline operations) computed from the fact and dimensions.

Windows here run after aggregates keyed by calendar day / week / month and a
handful of categorical values, except the per-merchant ranks, which use the
range-partitioned ``global_order``, and the per-reason top lists, which Spark
plans as a partial top-k before the shuffle (WindowGroupLimit).
"""
from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.joins import dimension_side, rollup_through_dimension
from ..operators.lineage import materialize
from ..operators.ranking import dense_rank_by_value, global_order
from ..session import shared_work_dir
from ..sources.fixtures import Tables
from . import analysis, cube, kpis

TOP_SHARE_NS = (10, 50)
TOP_INDUSTRIES = 3
RISK_RETENTION = 0.4
CHECKPOINT_MONTHS = (1, 3, 6)
MOM_DECLINE_LIMIT = -0.10
TOP_MERCHANTS_FOR_MOM = 50
LOW_YIELD = 0.015
APPROVAL_ALERT_DROP = 0.01
ROLLING_DAYS = 28


def _daily(t: Tables) -> DataFrame:
    return t.transactions.groupBy(F.col("txn_date").alias("day")).agg(
        X.gpv_sum().alias("gpv"), F.count(F.lit(1)).alias("txns"),
        X.count_when(X.APPROVED).alias("approved_txns"), X.fee_sum().alias("fees"))


def fee_yield_daily(t: Tables) -> DataFrame:
    d = _daily(t).withColumn("gpv", F.coalesce("gpv", F.lit(0)))
    return d.select("day", X.as_double("gpv").alias("gpv"), X.as_double("fees").alias("total_fees"),
                    X.safe_div("fees", "gpv").alias("fee_yield"))


def _direction(c) -> F.Column:
    return F.when(c > 0, "up").when(c < 0, "down").when(c == 0, "flat")


def kpi_daily_delta(t: Tables) -> DataFrame:
    d = _daily(t).withColumn("gpv", F.coalesce("gpv", F.lit(0))).withColumn(
        "approval_rate", X.safe_div("approved_txns", "txns"))
    w = Window.orderBy("day")  # one row per day
    gd = F.col("gpv") - F.lag("gpv").over(w)
    ad = F.col("approval_rate") - F.lag("approval_rate").over(w)
    out = d.select("day", "gpv", "approval_rate", gd.alias("gpv_delta"), ad.alias("approval_delta"))
    return out.select("day", X.as_double("gpv").alias("gpv"), "approval_rate",
                      X.as_double("gpv_delta").alias("gpv_delta"), "approval_delta",
                      _direction(F.col("gpv_delta")).alias("gpv_direction"),
                      _direction(F.col("approval_delta")).alias("approval_direction"))


def top3_industries_latest_year(t: Tables, k: int = TOP_INDUSTRIES) -> DataFrame:
    latest = t.transactions.agg(F.max("partition_year")).scalar()
    fact = t.transactions.where(X.APPROVED & (F.col("partition_year") == latest))
    g = rollup_through_dimension(t, fact, "merchants", "merchant_id", ["partition_year"], ["industry"],
                                 {"gpv": X.money_sum("amount")})
    return g.orderBy(F.col("gpv").desc(), "industry").limit(k).select(
        F.col("partition_year").alias("metric_year"), "industry", X.as_double("gpv").alias("gpv"))


def active_merchants(t: Tables) -> DataFrame:
    return kpis.merchant_performance(t).agg(F.count(F.lit(1)).alias("active_merchants"))


def _merchant_gpv(t: Tables) -> DataFrame:
    return t.transactions.groupBy("merchant_id").agg(X.gpv_sum().alias("gpv"))


def top_n_gpv_share(t: Tables, ns=TOP_SHARE_NS) -> DataFrame:
    per = _merchant_gpv(t)
    # The first rows come from a partial top-n of each task; total and top read one exchange.
    order = [F.col("gpv").desc_nulls_last(), F.col("merchant_id").asc()]
    top = per.orderBy(*order).limit(max(ns)).withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    sums = top.agg(*[F.sum(F.when(F.col("rn") <= n, F.col("gpv"))).alias(f"top{n}") for n in ns]).withColumn(
        "total", per.agg(F.sum("gpv")).scalar())
    rows = sums.select("total", F.explode(F.array(*[
        F.struct(F.lit(n).alias("top_n"), F.col(f"top{n}").alias("top")) for n in ns])).alias("r"))
    return rows.select("r.top_n", X.as_double("r.top").alias("gpv_top"), X.as_double("total").alias("gpv_total"),
                       X.safe_div("r.top", "total").alias("share"))


def region_gpv_share(t: Tables) -> DataFrame:
    g = rollup_through_dimension(t, t.transactions, "merchants", "merchant_id", [], ["region"],
                                 {"gpv": X.gpv_sum()})
    total = F.sum("gpv").over(Window.partitionBy())  # one row per region
    return g.select("region", X.as_double("gpv").alias("gpv"), X.safe_div("gpv", total).alias("gpv_share"))


def rank_percentile(t: Tables) -> DataFrame:
    tm = materialize(kpis.top_merchants(t), "top-merchants")
    mx = tm.agg(F.max("gpv_rank")).scalar()
    return tm.select("merchant_id", "gpv_rank",
                     (F.lit(1.0) - F.col("gpv_rank") / mx).alias("rank_percentile"))


def merchant_detail(t: Tables) -> DataFrame:
    per = t.transactions.groupBy("merchant_id").agg(
        X.gpv_sum().alias("gpv"), F.count(F.lit(1)).alias("txns"), X.count_when(X.APPROVED).alias("approved_txns"))
    dim = t.merchants.select("merchant_id", "merchant_size", "region", "industry")
    return per.join(dimension_side(t, "merchants", dim), "merchant_id").select(
        "merchant_id", "merchant_size", "region", "industry", X.as_double("gpv").alias("gpv"), "txns",
        "approved_txns", X.safe_div("approved_txns", "txns").alias("approval_rate"))


def merchant_daily_trend(t: Tables) -> DataFrame:
    d = t.transactions.groupBy("merchant_id", "txn_date").agg(
        X.gpv_sum_zero().alias("gpv"), F.count(F.lit(1)).alias("txns"),
        X.count_when(X.APPROVED).alias("approved_txns"))
    return d.select("merchant_id", "txn_date", X.as_double("gpv").alias("gpv"), "txns",
                    X.safe_div("approved_txns", "txns").alias("approval_rate"))


def overall_decline_rate(t: Tables) -> DataFrame:
    a = t.transactions.agg(X.count_unless(X.APPROVED).alias("declined_txns"), F.count(F.lit(1)).alias("total_txns"))
    return a.select("declined_txns", "total_txns", X.safe_div("declined_txns", "total_txns").alias("decline_rate"))


def declined_dollars(t: Tables) -> DataFrame:
    declined = t.transactions.where(~X.APPROVED)
    return declined.groupBy("channel").agg(
        X.as_double(X.money_sum("amount")).alias("declined_amount"), F.count(F.lit(1)).alias("declined_txns"))


def _weekly_channel(t: Tables) -> DataFrame:
    return t.transactions.groupBy("channel", X.week_start("txn_date").alias("week_start_date")).agg(
        X.gpv_sum().alias("gpv"), F.count(F.lit(1)).alias("txns"), X.count_when(X.APPROVED).alias("approved_txns"),
        X.fee_sum().alias("fees"))


def channel_wow_drop(t: Tables) -> DataFrame:
    """Weekly change of each channel's approved amount, worst first."""
    w = Window.partitionBy("channel").orderBy("week_start_date")  # channels x calendar weeks
    g = _weekly_channel(t)
    return g.select("channel", "week_start_date", X.as_double("gpv").alias("gpv"),
                    X.safe_div("approved_txns", "txns").alias("approval_rate"),
                    X.as_double(F.lag("gpv").over(w)).alias("prev_gpv")).withColumn(
        "wow_growth", X.growth("gpv", "prev_gpv")).orderBy(F.col("wow_growth").asc_nulls_last(), "channel", "week_start_date")


def decline_share_by_reason_channel(t: Tables) -> DataFrame:
    g = t.transactions.where(F.col("decline_reason").isNotNull()).groupBy("decline_reason", "channel").agg(
        F.count(F.lit(1)).alias("declined_txns"))
    tot = F.sum("declined_txns").over(Window.partitionBy("channel"))  # reasons x channels
    return g.select("decline_reason", "channel", "declined_txns", X.safe_div("declined_txns", tot).alias("share"))


def region_channel_decline_rate(t: Tables) -> DataFrame:
    g = rollup_through_dimension(t, t.transactions, "merchants", "merchant_id", ["channel"], ["region"],
                                 {"declined_txns": X.count_unless(X.APPROVED), "total_txns": F.count(F.lit(1))})
    return g.select("region", "channel", "declined_txns", "total_txns",
                    X.safe_div("declined_txns", "total_txns").alias("decline_rate"))


def decline_contribution(t: Tables) -> DataFrame:
    g = t.transactions.where(F.col("decline_reason").isNotNull()).groupBy("decline_reason").agg(
        F.count(F.lit(1)).alias("declined_txns"))
    tot = F.sum("declined_txns").over(Window.partitionBy())  # one row per reason
    return g.select("decline_reason", "declined_txns", X.safe_div("declined_txns", tot).alias("contribution"))


def decline_exposed_merchants(t: Tables) -> DataFrame:
    """Every merchant with declines, ranked within each reason by their number (ties by merchant_id).

    One global ordering by reason; a reason's rank starts after the merchants of the reasons before.
    """
    g = t.transactions.where(F.col("decline_reason").isNotNull()).groupBy("decline_reason", "merchant_id").agg(
        F.count(F.lit(1)).alias("declined_txns"))
    g = materialize(g, "exposed")
    ordered = global_order(g, [F.col("decline_reason"), F.col("declined_txns").desc(), F.col("merchant_id")], row_number="rn")
    earlier = Window.orderBy("decline_reason").rowsBetween(Window.unboundedPreceding, -1)  # one row per reason
    starts = g.groupBy("decline_reason").agg(F.count(F.lit(1)).alias("n")).select(
        "decline_reason", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return ordered.join(F.broadcast(starts), "decline_reason").select(
        "decline_reason", "merchant_id", "declined_txns", (F.col("rn") - F.col("start")).alias("exposure_rank"))


def cohort_size(t: Tables) -> DataFrame:
    return kpis.merchant_cohort_sizes(t)


def retention_checkpoints(t: Tables, months=CHECKPOINT_MONTHS) -> DataFrame:
    mc = kpis.merchant_cohorts(t)
    return mc.groupBy("signup_month").agg(*[
        F.max(F.when(F.col("month_index") == m, F.col("retention_rate"))).alias(f"retention_m{m}") for m in months])


def at_risk_cohorts(t: Tables, limit: float = RISK_RETENTION) -> DataFrame:
    """Cohorts with months of low retention: how many such months, the merchants seen in at least
    one of them (each once), and their visits."""
    activity = kpis.merchant_cohort_activity(t).select("signup_month", "month_index", "merchant_id")
    activity = materialize(activity, "cohort-activity")
    cells = activity.groupBy("signup_month", "month_index").agg(F.count(F.lit(1)).alias("retained_merchants"))
    sizes = F.broadcast(kpis.merchant_cohort_sizes(t))  # one row per signup month
    risky = cells.join(sizes, "signup_month").withColumn(
        "retention_rate", X.safe_div("retained_merchants", "cohort_merchants")).where(F.col("retention_rate") < limit)
    merchants = activity.join(F.broadcast(risky.select("signup_month", "month_index")), ["signup_month", "month_index"]).select(
        "signup_month", "merchant_id").distinct().groupBy("signup_month").agg(F.count(F.lit(1)).alias("at_risk_merchants"))
    per = risky.groupBy("signup_month").agg(
        F.count(F.lit(1)).alias("at_risk_cells"), F.sum("retained_merchants").alias("retained_in_at_risk_cells"),
        F.min("retention_rate").alias("min_retention"), F.max("cohort_merchants").alias("cohort_merchants"))
    return per.join(F.broadcast(merchants), "signup_month")


def retention_by_size_region(t: Tables) -> DataFrame:
    cells = kpis.merchant_cohort_activity(t, ("merchant_size", "region")).groupBy("merchant_size", "region", "month_index").agg(
        F.count(F.lit(1)).alias("retained_merchants"))
    sizes = t.merchants.groupBy("merchant_size", "region").agg(F.count(F.lit(1)).alias("merchants"))
    return cells.join(F.broadcast(sizes), ["merchant_size", "region"]).select(  # sizes x regions
        "merchant_size", "region", "month_index", "retained_merchants",
        X.safe_div("retained_merchants", "merchants").alias("retention_rate"))


def cohort_dropoff(t: Tables) -> DataFrame:
    return kpis.merchant_cohorts(t).withColumn("dropoff", F.lit(1.0) - F.col("retention_rate"))


def weighted_retention(t: Tables) -> DataFrame:
    cells = kpis.merchant_cohort_activity(t).groupBy("signup_month", "month_index").agg(
        F.count(F.lit(1)).alias("retained"))
    sizes = kpis.merchant_cohort_sizes(t)
    j = cells.join(F.broadcast(sizes), "signup_month")
    g = j.groupBy("month_index").agg(F.sum("retained").alias("retained_merchants"),
                                     F.sum("cohort_merchants").alias("cohort_merchants"))
    return g.select("month_index", "retained_merchants", "cohort_merchants",
                    X.safe_div("retained_merchants", "cohort_merchants").alias("weighted_retention"))


def cohort_delta(t: Tables) -> DataFrame:
    mc = kpis.merchant_cohorts(t)
    w = Window.partitionBy("month_index").orderBy("signup_month")  # cohorts: calendar months
    return mc.select("signup_month", "month_index", "retention_rate",
                     (F.col("retention_rate") - F.lag("retention_rate").over(w)).alias("delta_vs_prior_cohort"))


def cohort_members(t: Tables) -> DataFrame:
    return kpis.merchant_cohort_activity(t, ("merchant_size", "region", "industry")).select(
        "signup_month", "month_index", "merchant_id", "merchant_size", "region", "industry")


def filtered_kpis(t: Tables, start: str | None = None, end: str | None = None, regions=None, industries=None,
                  sizes=None, channels=None, methods=None) -> DataFrame:
    """KPI tiles under the dashboard's global filters (each filter optional)."""
    tx = t.transactions
    # the year bounds let a year/month-partitioned fact skip whole partitions
    if start:
        tx = tx.where((F.col("txn_date") >= F.lit(start).cast("date"))
                      & (F.col("partition_year") >= int(start[:4])))
    if end:
        tx = tx.where((F.col("txn_date") <= F.lit(end).cast("date"))
                      & (F.col("partition_year") <= int(end[:4])))
    if channels:
        tx = tx.where(F.col("channel").isin(*channels))
    if methods:
        tx = tx.where(F.col("payment_method").isin(*methods))
    # one scan: sums per merchant (partial map-side), then the merchants asked for, totals and the merchant count
    sums = cube.kpi_sums()
    per = tx.groupBy("merchant_id").agg(*[v.alias(k) for k, v in sums.items()])
    if regions or industries or sizes:
        dim = t.merchants
        if regions:
            dim = dim.where(F.col("region").isin(*regions))
        if industries:
            dim = dim.where(F.col("industry").isin(*industries))
        if sizes:
            dim = dim.where(F.col("merchant_size").isin(*sizes))
        per = per.join(dimension_side(t, "merchants", dim.select("merchant_id")), "merchant_id", "left_semi")
    return cube.kpi_tiles(per.agg(*[F.sum(k).alias(k) for k in sums], F.count(F.lit(1)).alias("active_merchants")))


EXAMPLE_FILTERS = dict(start="1996-01-01", end="2000-12-31", regions=["EUROPE", "ASIA", "AMERICA"],
                       sizes=["medium", "enterprise"], channels=["pos", "ecom"], methods=["card", "ach"])


def filtered_kpis_example(t: Tables) -> DataFrame:
    return filtered_kpis(t, **EXAMPLE_FILTERS)


def filtered_kpis_cube(t: Tables) -> DataFrame:
    """The same tiles from the written cube."""
    return cube.filtered_kpis(cube.write_cube(t, shared_work_dir(t.spark, "cube")), **EXAMPLE_FILTERS)


def wow_growth(t: Tables) -> DataFrame:
    g = t.transactions.groupBy(X.week_start("txn_date").alias("week_start_date")).agg(X.gpv_sum().alias("gpv"))
    w = Window.orderBy("week_start_date")  # one row per calendar week
    return g.select("week_start_date", X.as_double("gpv").alias("gpv"),
                    X.as_double(F.lag("gpv").over(w)).alias("prev_gpv")).withColumn(
        "wow_growth", X.growth("gpv", "prev_gpv"))


def rolling_28d_gpv(t: Tables, days: int = ROLLING_DAYS) -> DataFrame:
    d = _daily(t).withColumn("gpv", F.coalesce("gpv", F.lit(0))).withColumn("dn", F.unix_date("day"))
    w = Window.orderBy("dn").rangeBetween(-(days - 1), 0)  # calendar days, one row per day
    return d.select("day", X.as_double("gpv").alias("gpv"), X.as_double(F.sum("gpv").over(w)).alias("gpv_28d"))


def decline_rate_decomposition(t: Tables) -> DataFrame:
    """One rollup by reason, channel and industry; the totals of channel and industry are sums over it."""
    fact = t.transactions.withColumn("decline_reason", F.coalesce("decline_reason", F.lit("unknown")))
    cells = rollup_through_dimension(t, fact, "merchants", "merchant_id", ["decline_reason", "channel"], ["industry"],
                                     {"declined_txns": X.count_unless(X.APPROVED), "txns": F.count(F.lit(1))})
    whole = Window.partitionBy("channel", "industry")  # a row per reason
    return cells.withColumn("total_txns", F.sum("txns").over(whole)).where(F.col("declined_txns") > 0).select(
        "decline_reason", "channel", "industry", "declined_txns", "total_txns",
        X.safe_div("declined_txns", "total_txns").alias("decline_rate"))


def seasonal_surge(t: Tables) -> DataFrame:
    wk = t.transactions.groupBy(X.week_start("txn_date").alias("w")).agg(
        X.gpv_sum_zero().alias("gpv"), F.count(F.lit(1)).alias("txns"), X.count_when(X.APPROVED).alias("ok"))
    m = F.month("w")
    season = F.when(m.isin(11, 12), "nov_dec").when(m.isin(1, 2, 3), "q1")
    s = wk.withColumn("season", season).where(F.col("season").isNotNull()).withColumn("year", F.year("w"))

    def part(name):
        c = F.col("season") == name
        return [X.mean_from_sums(F.sum(F.when(c, F.col("gpv"))), F.count(F.when(c, 1))).alias(f"{name}_avg_weekly_gpv"),
                X.safe_div(F.sum(F.when(c, F.col("ok"))), F.sum(F.when(c, F.col("txns")))).alias(f"{name}_approval")]
    g = s.groupBy("year").agg(*part("q1"), *part("nov_dec"))
    return g.select(
        F.col("year").cast("int").alias("year"), "q1_avg_weekly_gpv", "nov_dec_avg_weekly_gpv",
        (X.safe_div("nov_dec_avg_weekly_gpv", "q1_avg_weekly_gpv") - 1).alias("surge"),
        "q1_approval", "nov_dec_approval",
        ((F.col("nov_dec_approval") - F.col("q1_approval")) * 100).alias("approval_diff_pts"))


def industry_gpv_share(t: Tables) -> DataFrame:
    g = rollup_through_dimension(t, t.transactions, "merchants", "merchant_id", [], ["industry"],
                                 {"gpv": X.gpv_sum(), "approved_txns": X.count_when(X.APPROVED),
                                  "txns": F.count(F.lit(1))})
    allw = Window.partitionBy()  # one row per industry
    return g.select("industry", X.as_double("gpv").alias("gpv"),
                    X.safe_div("gpv", F.sum("gpv").over(allw)).alias("gpv_share"),
                    X.safe_div("approved_txns", "txns").alias("approval_rate"),
                    X.safe_div("approved_txns", F.sum("approved_txns").over(allw)).alias("approved_share"))


def region_decline_vs_gpv_share(t: Tables) -> DataFrame:
    g = rollup_through_dimension(t, t.transactions, "merchants", "merchant_id", [], ["region"],
                                 {"gpv": X.gpv_sum(), "declined_txns": X.count_unless(X.APPROVED)})
    allw = Window.partitionBy()  # one row per region
    return g.select("region", X.safe_div("declined_txns", F.sum("declined_txns").over(allw)).alias("decline_share"),
                    X.safe_div("gpv", F.sum("gpv").over(allw)).alias("gpv_share"))


def mom_decliners_in_top(t: Tables, top: int = TOP_MERCHANTS_FOR_MOM, limit: float = MOM_DECLINE_LIMIT) -> DataFrame:
    """Months of decline of the top merchants; totals and months both follow from one table of merchant months."""
    months = materialize(t.transactions.groupBy("merchant_id", X.month_start("txn_date").alias("month")).agg(
        X.gpv_sum().alias("gpv")), "merchant-months")
    totals = months.groupBy("merchant_id").agg(X.as_double(F.sum("gpv")).alias("gpv"))
    known = totals.join(dimension_side(t, "merchants", t.merchants.select("merchant_id")), "merchant_id", "left_semi")
    ranked = dense_rank_by_value(known, "gpv", "gpv_rank").where(F.col("gpv_rank") <= top).select("merchant_id", "gpv_rank")
    return analysis.month_growth(months).where(F.col("mom_growth") <= limit).join(ranked, "merchant_id").select(
        "merchant_id", "gpv_rank", "month", "gpv", "prev_gpv", "mom_growth")


def low_yield_channels(t: Tables, limit: float = LOW_YIELD) -> DataFrame:
    g = _weekly_channel(t)
    y = X.safe_div("fees", "gpv")
    return g.select("channel", "week_start_date", y.alias("fee_yield"),
                    F.coalesce(y < limit, F.lit(False)).alias("low_yield"))


def approval_drop_alerts(t: Tables, drop: float = APPROVAL_ALERT_DROP) -> DataFrame:
    d = _daily(t).withColumn("approval_rate", X.safe_div("approved_txns", "txns"))
    w = Window.orderBy("day")  # one row per day
    d = d.select("day", "approval_rate", F.lag("approval_rate").over(w).alias("prev_rate"))
    return d.withColumn("drop_pts", (F.col("prev_rate") - F.col("approval_rate")) * 100).where(
        (F.col("prev_rate") - F.col("approval_rate")) > drop)


def approval_by_merchant_method_day(t: Tables) -> DataFrame:
    g = t.transactions.groupBy("merchant_id", "payment_method", "txn_date").agg(
        F.count(F.lit(1)).alias("txns"), X.count_when(X.APPROVED).alias("approved_txns"))
    return g.withColumn("approval_rate", X.safe_div("approved_txns", "txns"))


def customer_cohort_weekly_retention(t: Tables) -> DataFrame:
    act = (t.transactions.where(X.APPROVED)
           .select("customer_id", X.week_start("txn_date").alias("activity_week")).distinct())
    cohort = t.customers.select("customer_id", X.week_start("join_date").alias("join_week"))
    cells = (act.join(dimension_side(t, "customers", cohort), "customer_id").where(F.col("activity_week") >= F.col("join_week"))
             .groupBy("join_week", (F.datediff("activity_week", "join_week") / 7).cast("bigint").alias("week_index"))
             .agg(F.count(F.lit(1)).alias("retained_customers")))
    sizes = cohort.groupBy("join_week").agg(F.count(F.lit(1)).alias("cohort_customers"))
    return cells.join(F.broadcast(sizes), "join_week").select(  # one row per calendar week
        "join_week", "week_index", "retained_customers", "cohort_customers",
        X.safe_div("retained_customers", "cohort_customers").alias("retention_rate"))


QUERIES = {
    "fee_yield_daily": fee_yield_daily,
    "kpi_daily_delta": kpi_daily_delta,
    "top3_industries_latest_year": top3_industries_latest_year,
    "active_merchants": active_merchants,
    "top_n_gpv_share": top_n_gpv_share,
    "region_gpv_share": region_gpv_share,
    "rank_percentile": rank_percentile,
    "merchant_detail": merchant_detail,
    "merchant_daily_trend": merchant_daily_trend,
    "overall_decline_rate": overall_decline_rate,
    "declined_dollars": declined_dollars,
    "channel_wow_drop": channel_wow_drop,
    "decline_share_by_reason_channel": decline_share_by_reason_channel,
    "region_channel_decline_rate": region_channel_decline_rate,
    "decline_contribution": decline_contribution,
    "decline_exposed_merchants": decline_exposed_merchants,
    "cohort_size": cohort_size,
    "retention_checkpoints": retention_checkpoints,
    "at_risk_cohorts": at_risk_cohorts,
    "retention_by_size_region": retention_by_size_region,
    "cohort_dropoff": cohort_dropoff,
    "weighted_retention": weighted_retention,
    "cohort_delta": cohort_delta,
    "cohort_members": cohort_members,
    "filtered_kpis": filtered_kpis_example,
    "filtered_kpis_cube": filtered_kpis_cube,
    "wow_growth": wow_growth,
    "rolling_28d_gpv": rolling_28d_gpv,
    "decline_rate_decomposition": decline_rate_decomposition,
    "seasonal_surge": seasonal_surge,
    "industry_gpv_share": industry_gpv_share,
    "region_decline_vs_gpv_share": region_decline_vs_gpv_share,
    "mom_decliners_in_top": mom_decliners_in_top,
    "low_yield_channels": low_yield_channels,
    "approval_drop_alerts": approval_drop_alerts,
    "approval_by_merchant_method_day": approval_by_merchant_method_day,
    "customer_cohort_weekly_retention": customer_cohort_weekly_retention,
}
