"""Time split, ranking metrics, lift table and latest-week scoring rules.

A scored frame has columns merchant_id, week_start_date, y_true (int) and
score (double). Metrics never sort all rows in one task: per-score counts
(one row per distinct score, so ties cannot make a hot partition) are ranked
with ``global_order``; top-k, deciles and medians select the rows at the cuts
(``operators/selection``) and order nothing, with (merchant_id,
week_start_date) as the tie-break.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import materialize
from ..operators.ranking import global_order
from ..operators.selection import first_rows, median
from ..sources import footers
from ..sources.fixtures import Tables
from . import features as FT

SPLIT_WEEKS_BACK = 8
FALLBACK_QUANTILE = 0.8
TOP_K_PCTS = (0.01, 0.05, 0.10)
DECILES = 10
# Risk bucket limits and outreach rules.
RISK_BUCKETS = [(0.8, "critical"), (0.6, "high"), (0.4, "medium")]
RISK_DEFAULT = "low"
RULES = [
    ("declines", "Review decline spikes and risk reasons"),
    ("volume_drop", "Account outreach: volume down 40%+"),
    ("low_activity", "Engage merchant to drive weekly activity"),
    ("payment_mix", "Promote alternative payment mix"),
    ("steady", "Monitor health via CSM check-in"),
]
DECLINE_RULE_RATE = 0.25
VOLUME_RULE_SHARE_OF_MEDIAN = 0.6
LOW_ACTIVITY_FREQUENCY = 1
CARD_HEAVY_SHARE = 0.9
SEARCH_RECENT_WEEKS = 26
#: Labelled rows a classifier is fitted on by default in the model search.
SEARCH_MAX_ROWS = 200_000
SEED = 42
ID_COLS = ["merchant_id", "week_start_date"]
EXPLICIT_TRAIN_END = "1997-06-30"


# ---------------------------------------------------------------- split
def labelled(training: DataFrame, label: str) -> DataFrame:
    return training.where(F.col(label).isNotNull())


def split_fallback_quantile_of(lab: DataFrame) -> DataFrame:
    """0.8 quantile (linear interpolation) of the labelled weeks, floored to a date.

    The exact percentile keeps one entry per distinct week: bounded by the calendar.
    """
    q = F.percentile(F.unix_date("week_start_date"), F.lit(FALLBACK_QUANTILE))
    return lab.agg(F.date_from_unix_date(F.floor(q).cast("int")).alias("quantile_date"))


def split_date_value(lab: DataFrame, train_end_date: str | None = None):
    """The last training week: the explicit date, else latest labelled week - 8 weeks;
    the 0.8 quantile of the weeks if no labelled row lies after that. A ValueError if
    a side has no rows. One small aggregate; the single date is used as a literal."""
    import datetime as dt

    q = F.percentile(F.unix_date("week_start_date"), F.lit(FALLBACK_QUANTILE))
    row = lab.agg(F.min("week_start_date").alias("first"), F.max("week_start_date").alias("latest"),
                  F.date_from_unix_date(F.floor(q).cast("int")).alias("q")).first()
    if row["latest"] is None:
        raise ValueError("no labelled rows")
    cut = dt.date.fromisoformat(str(train_end_date)[:10]) if train_end_date else row["latest"] - dt.timedelta(weeks=SPLIT_WEEKS_BACK)
    if cut >= row["latest"]:
        cut = row["q"]
    if not row["first"] <= cut < row["latest"]:
        raise ValueError(f"the split at {cut} leaves no training or no holdout rows")
    return cut


def with_side(lab: DataFrame, train_end_date: str | None = None) -> DataFrame:
    split = F.lit(split_date_value(lab, train_end_date))
    return lab.withColumn("split_date", split).withColumn(
        "side", F.when(F.col("week_start_date") <= F.col("split_date"), "train").otherwise("test"))


def split_stats(training: DataFrame, label: str = "churn_4w", train_end_date: str | None = None) -> DataFrame:
    sided = with_side(labelled(training, label), train_end_date)
    return sided.groupBy("side", "split_date").agg(
        F.count(F.lit(1)).alias("rows"), F.min("week_start_date").alias("start_date"),
        F.max("week_start_date").alias("end_date"))


# ---------------------------------------------------------------- deterministic stand-in scorers
def standin_scores(frame: DataFrame) -> dict[str, Column]:
    """Deterministic scores from feature columns (exact oracles for the metric code)."""
    key_term = (F.col("merchant_id") * 31 + F.col("week_of_year")) % 100 / F.lit(100.0)
    return {
        "decline_signal": F.lit(0.8) * F.col("decline_rate") + F.lit(0.2) * key_term,
        "low_activity_signal": F.lit(1.0) / (F.lit(1.0) + F.col("txn_frequency")),
        "card_mix_signal": F.col("share_card"),
    }


def scored_holdout(training: DataFrame, label: str = "churn_4w", model: str = "decline_signal") -> DataFrame:
    sided = with_side(labelled(training, label))
    test = sided.where(F.col("side") == "test")
    return test.select(*ID_COLS, F.col(label).cast("int").alias("y_true"),
                       standin_scores(test)[model].alias("score"))


# ---------------------------------------------------------------- ranking metrics
def _score_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("score").agg(
        F.sum("y_true").cast("bigint").alias("pos"),
        F.sum(1 - F.col("y_true")).cast("bigint").alias("neg"))


def roc_auc_average_precision(scored: DataFrame) -> DataFrame:
    """One row: roc_auc (tie-aware) and average_precision (step-wise, per distinct score).

    AUC = sum over scores (desc) of neg * (tp_before + pos/2) / (P * N), done in
    integers (2x) and divided once. Both are NULL when a class is missing.
    """
    counts = global_order(_score_counts(scored), [F.col("score").desc()],
                          running_sums={"tp": "pos", "fp": "neg"})
    terms = counts.select(
        (F.col("neg") * (2 * (F.col("tp") - F.col("pos")) + F.col("pos"))).alias("auc2"),
        (F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("ap_term"),
        "pos", "neg")
    tot = terms.agg(F.sum("auc2").alias("auc2"), F.sum("ap_term").alias("ap"),
                    F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return tot.select(
        F.when(ok, F.col("auc2").cast("double") / (F.lit(2.0) * F.col("P") * F.col("N"))).alias("roc_auc"),
        F.when(F.col("P") > 0, F.round(F.col("ap") / F.col("P"), 12)).alias("average_precision"))


#: Order of rows in top-k cuts and deciles.
RANKING = [("score", True), ("merchant_id", False), ("week_start_date", False)]


def _totals(scored: DataFrame) -> tuple[int, int]:
    row = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("y_true").alias("p")).first()
    return int(row["n"]), int(row["p"] or 0)


def precision_recall_at_k(scored: DataFrame, pcts=TOP_K_PCTS) -> DataFrame:
    """k = max(1, floor(n * pct)); precision = hits / k; recall = hits / positives (0 without positives)."""
    n, positives = _totals(scored)
    ks = [max(1, int(math.floor(n * float(p)))) for p in pcts]
    hits = scored.agg(*[F.sum(F.when(top, F.col("y_true")).otherwise(0)).alias(f"tp{i}")
                        for i, top in enumerate(first_rows(scored, RANKING, ks))])
    rows = hits.select(F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("pct"), F.lit(k).cast("bigint").alias("k"), F.col(f"tp{i}").alias("tp"))
        for i, (p, k) in enumerate(zip(pcts, ks))])).alias("r")).select("r.*")
    recall = (F.col("tp") / F.lit(positives)) if positives > 0 else F.lit(0.0)
    return rows.select("pct", "k", (F.col("tp") / F.col("k")).alias("precision"), recall.alias("recall"))


def lift_table(scored: DataFrame, deciles: int = DECILES) -> DataFrame:
    """Equal-count slices of ceil(n/deciles) rows by score (trailing slices may be short or absent)."""
    n, positives = _totals(scored)
    slice_size = math.ceil(n / deciles) or 1
    cuts = first_rows(scored, RANKING, [slice_size * i for i in range(1, deciles) if slice_size * i < n])
    buckets = scored.withColumn("decile", sum(((~cut).cast("int") for cut in cuts), F.lit(1)))
    per = buckets.groupBy("decile").agg(
        F.count(F.lit(1)).alias("population"),
        F.round(F.avg("score"), 10).alias("avg_score"),
        F.sum("y_true").cast("bigint").alias("positives"))
    cum = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # <= 10 rows
    if positives > 0:
        baseline = F.lit(positives) / F.lit(n)
        lift = (F.col("positives") / F.col("population")) / baseline
        capture = F.sum("positives").over(cum) / F.lit(positives)
    else:
        lift = capture = F.lit(0.0)
    return per.select("decile", "population", "avg_score", "positives", lift.alias("lift"),
                      capture.alias("cumulative_capture"))


def model_metrics(scored: DataFrame, model: str) -> DataFrame:
    """One metrics row: roc_auc, average precision, precision/recall at 1/5/10 %.

    The one-row parts are stacked and folded with MAX (no cross join, no
    repeated subqueries).
    """
    pk = precision_recall_at_k(scored)
    cols = []
    for p in TOP_K_PCTS:
        tag = f"{int(round(p * 100))}pct"
        at = F.col("pct") == float(p)
        cols += [F.max(F.when(at, F.col("precision"))).alias(f"precision_at_{tag}"),
                 F.max(F.when(at, F.col("recall"))).alias(f"recall_at_{tag}")]
    wide = pk.agg(*cols)
    auc = roc_auc_average_precision(scored)
    both = auc.unionByName(wide, allowMissingColumns=True)
    names = auc.columns + wide.columns
    return both.agg(*[F.max(c).alias(c) for c in names]).select(F.lit(model).alias("model"), *names)


def best_model(metrics: DataFrame, order: list[str]) -> DataFrame:
    """Highest roc_auc; NULL ranks lowest; the earlier model wins ties."""
    pos = F.lit(len(order))
    for i, m in reversed(list(enumerate(order))):
        pos = F.when(F.col("model") == m, F.lit(i)).otherwise(pos)
    return metrics.orderBy(F.col("roc_auc").desc_nulls_last(), pos).limit(1)


# ---------------------------------------------------------------- medians, latest week, scoring rules
def exact_median(df: DataFrame, column: str) -> DataFrame:
    """Exact median (mean of the two middle values for even counts), one row; the middle values are selected."""
    kind = dict(df.dtypes)[column]
    low, high = (F.lit(v).cast(kind) for v in median(df, column))
    return df.sparkSession.range(1).select(((low + high) / 2).alias(f"median_{column}"))


def exact_median_value(df: DataFrame, column: str):
    return exact_median(df, column).first()[0]


def latest_week(features: DataFrame, latest=None) -> DataFrame:
    """Rows of the latest week (one date, computed with one aggregate unless given)."""
    if latest is None:
        latest = features.agg(F.max("week_start_date")).first()[0]
    return features.where(F.col("week_start_date") == F.lit(latest))


def first_week(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("week_start_date") == F.lit(rows.agg(F.min("week_start_date")).first()[0]))


def risk_bucket(score: Column) -> Column:
    out = None
    for limit, name in RISK_BUCKETS:
        out = F.when(score >= limit, name) if out is None else out.when(score >= limit, name)
    return out.otherwise(RISK_DEFAULT)


def recommendation(median_gpv: Column) -> tuple[Column, Column]:
    conds = [
        F.col("decline_rate") >= DECLINE_RULE_RATE,
        F.col("gpv") <= F.lit(VOLUME_RULE_SHARE_OF_MEDIAN) * median_gpv,
        F.col("txn_frequency") < LOW_ACTIVITY_FREQUENCY,
        F.col("share_card") > CARD_HEAVY_SHARE,
    ]
    driver = action = None
    for cond, (d, a) in zip(conds, RULES):
        driver = F.when(cond, d) if driver is None else driver.when(cond, d)
        action = F.when(cond, a) if action is None else action.when(cond, a)
    return driver.otherwise(RULES[-1][0]), action.otherwise(RULES[-1][1])


def minmax_scale(df: DataFrame, raw: str, out: str) -> DataFrame:
    """(x - min) / (max - min + 1e-9) with min / max as scalar subqueries."""
    lo, hi = df.agg(F.min(raw), F.max(raw)).first()
    return df.withColumn(out, (F.col(raw) - F.lit(lo)) / (F.lit(hi) - F.lit(lo) + F.lit(1e-9)))


def outreach(features: DataFrame, scored_latest: DataFrame) -> DataFrame:
    """Ranked outreach list: latest-week rows with score, bucket, driver, action, rank 1..n."""
    driver, action = recommendation(F.lit(exact_median_value(features, "gpv")))
    rows = scored_latest.select(
        "merchant_id", "week_start_date", F.col("score").alias("churn_risk_score"),
        risk_bucket(F.col("score")).alias("risk_bucket"), driver.alias("top_driver"),
        action.alias("recommended_action"))
    order = [F.col("churn_risk_score").desc(), F.col("merchant_id").asc()]
    return global_order(rows, order, row_number="rank")


def bounded_sample(df: DataFrame, max_rows: int | None, keys: list[str] = ID_COLS) -> DataFrame:
    """About ``max_rows`` rows (all, if there are no more), those whose seeded hash of the keys is low.

    A threshold on the hash, so no task sorts or gathers the rows.
    """
    n = df.count() if max_rows else 0
    if not max_rows or n <= max_rows:
        return df
    share = F.pmod(F.xxhash64(F.lit(SEED), *keys), F.lit(1 << 30))
    return df.where(share < int(max_rows / n * (1 << 30)))


def search_training_sample(train: DataFrame, recent_weeks: int | None = None,
                           max_rows: int | None = SEARCH_MAX_ROWS) -> DataFrame:
    """Rows the model search is fitted on: of the last ``recent_weeks`` weeks of the training side if
    given (else of all), about ``max_rows`` at most by a seeded hash.

    Both are choices of the caller; neither depends on the number of rows.
    """
    if recent_weeks:
        latest = train.agg(F.max("week_start_date")).first()[0]
        train = train.where(F.col("week_start_date") >= F.date_sub(F.lit(latest), 7 * recent_weeks))
    return bounded_sample(train, max_rows)


# ---------------------------------------------------------------- query keys
SCORE_COLUMNS = ["decline_rate", "txn_frequency", "share_card", "week_of_year"]


def _labelled_rows(t: Tables, *columns: str, label: str = "churn_4w") -> DataFrame:
    """Key, label and the named columns of the labelled rows, written once."""
    return materialize(labelled(FT.training_table(t).select(*ID_COLS, label, *columns), label), "labelled")


def _score_rows(t: Tables) -> DataFrame:
    """The columns that scores and outreach rules use of all merchant weeks, written once."""
    return materialize(FT.merchant_week_features(t).select(*ID_COLS, "gpv", *SCORE_COLUMNS), "score-columns")


def _holdout(t: Tables, model: str = "decline_signal", training: DataFrame | None = None) -> DataFrame:
    tr = training if training is not None else _labelled_rows(t, *SCORE_COLUMNS)
    return scored_holdout(tr, model=model)


def q_train_test_split_stats(t: Tables) -> DataFrame:
    return split_stats(_labelled_rows(t))


def q_train_test_split_explicit(t: Tables) -> DataFrame:
    """The split at an explicit date."""
    return split_stats(_labelled_rows(t), train_end_date=EXPLICIT_TRAIN_END)


def q_split_fallback_quantile(t: Tables) -> DataFrame:
    return split_fallback_quantile_of(labelled(FT.training_table(t), "churn_4w"))


def q_roc_auc(t: Tables) -> DataFrame:
    return roc_auc_average_precision(_holdout(t)).select("roc_auc")


def q_average_precision(t: Tables) -> DataFrame:
    return roc_auc_average_precision(_holdout(t)).select("average_precision")


def q_precision_recall_at_k(t: Tables) -> DataFrame:
    return precision_recall_at_k(_holdout(t))


def q_lift_table(t: Tables) -> DataFrame:
    return lift_table(_holdout(t))


def q_standin_metrics(t: Tables) -> DataFrame:
    tr = _labelled_rows(t, *SCORE_COLUMNS)
    return reduce(DataFrame.unionByName,
                  [model_metrics(_holdout(t, m, tr), m) for m in STANDIN_ORDER])


STANDIN_ORDER = ["decline_signal", "low_activity_signal", "card_mix_signal"]


def q_best_model(t: Tables) -> DataFrame:
    return best_model(q_standin_metrics(t), STANDIN_ORDER).select("model", "roc_auc")


def q_balanced_class_weights(t: Tables) -> DataFrame:
    train = with_side(_labelled_rows(t)).where(F.col("side") == "train")
    per = train.groupBy(F.col("churn_4w").cast("int").alias("class")).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())  # one row per class
    return per.withColumn("weight", total / (F.lit(2.0) * F.col("rows")))


def q_feature_median(t: Tables) -> DataFrame:
    return exact_median(materialize(FT.merchant_week_features(t).select("gpv"), "gpv"), "gpv")


def latest_week_tables(t: Tables) -> Tables:
    """The tables with the transactions of the latest week alone.

    The latest day of a loaded warehouse comes from the footers of its files. The
    week is a range of dates, and of years and months, so a scan reads few
    partitions and pushes the range down.
    """
    import datetime as dt

    latest = (footers.largest(t.spark, f"{t.folder}/transactions", "txn_date") if t.folder
              else t.transactions.agg(F.max("txn_date")).first()[0])
    if latest is None:
        return t
    first = latest - dt.timedelta(days=latest.weekday())
    days = [first + dt.timedelta(days=i) for i in (0, 7)]
    months = sorted({(d.year, d.month) for d in (days[0], days[1] - dt.timedelta(days=1))})
    in_months = reduce(lambda a, b: a | b, [(F.col("partition_year") == y) & (F.col("partition_month") == m) for y, m in months])
    return t.replace(transactions=t.transactions.where(
        in_months & (F.col("txn_date") >= F.lit(days[0])) & (F.col("txn_date") < F.lit(days[1]))))


def q_latest_week_features(t: Tables) -> DataFrame:
    return FT.merchant_week_features(latest_week_tables(t))


def _latest_standin(t: Tables) -> tuple[DataFrame, DataFrame]:
    feats = _score_rows(t)
    latest = latest_week(feats)
    return feats, latest.withColumn("score", standin_scores(latest)["decline_signal"])


def _latest_scored(t: Tables) -> DataFrame:
    """The latest week alone, scored; other weeks are not read."""
    latest = FT.merchant_week_features(latest_week_tables(t))
    return latest.withColumn("score", standin_scores(latest)["decline_signal"])


def q_risk_bucket(t: Tables) -> DataFrame:
    return _latest_scored(t).select("merchant_id", "score", risk_bucket(F.col("score")).alias("risk_bucket"))


def q_recommended_action(t: Tables) -> DataFrame:
    feats, latest = _latest_standin(t)
    driver, action = recommendation(F.lit(exact_median_value(feats, "gpv")))
    return latest.select("merchant_id", driver.alias("top_driver"), action.alias("recommended_action"))


def q_outreach_scores(t: Tables) -> DataFrame:
    feats, latest = _latest_standin(t)
    return outreach(feats, latest)


def q_score_minmax(t: Tables) -> DataFrame:
    latest = materialize(_latest_scored(t).select("merchant_id", "decline_rate", "txn_frequency"), "latest")
    raw = latest.withColumn("raw", F.col("decline_rate") * 10 - F.col("txn_frequency"))
    return minmax_scale(raw, "raw", "scaled_score").select("merchant_id", "raw", "scaled_score")


def q_search_training_sample(t: Tables) -> DataFrame:
    train = with_side(_labelled_rows(t)).where(F.col("side") == "train")
    return search_training_sample(train, recent_weeks=SEARCH_RECENT_WEEKS).select(*ID_COLS, "churn_4w")


QUERIES = {
    "train_test_split_stats": q_train_test_split_stats,
    "train_test_split_explicit": q_train_test_split_explicit,
    "split_fallback_quantile": q_split_fallback_quantile,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "precision_recall_at_k": q_precision_recall_at_k,
    "lift_table": q_lift_table,
    "standin_metrics": q_standin_metrics,
    "best_model": q_best_model,
    "balanced_class_weights": q_balanced_class_weights,
    "feature_median": q_feature_median,
    "latest_week_features": q_latest_week_features,
    "risk_bucket": q_risk_bucket,
    "recommended_action": q_recommended_action,
    "outreach_scores": q_outreach_scores,
    "score_minmax": q_score_minmax,
    "search_training_sample": q_search_training_sample,
}
