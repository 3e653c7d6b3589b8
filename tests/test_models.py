"""Model pipelines on a planted-signal table: scores in [0, 1], one row per
holdout row, seeded reruns identical, AUC above 0.5."""
import datetime as dt
import random

import pytest
from helpers import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens.plans import evaluation as EV
from ledgerlens.plans import models as M
from ledgerlens.plans import search
from ledgerlens.session import shared_work_dir
from ledgerlens.sources.fixtures import Tables


def planted(spark, n=1500, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        signal = rnd.random()
        y = 1.0 if rnd.random() < 0.15 + 0.7 * signal else 0.0
        rows.append((i, dt.date(2024, 1, 1), y, signal, rnd.random(), float(i % 7)))
    df = spark.createDataFrame(rows, "merchant_id bigint, week_start_date date, label double, "
                                     "decline_rate double, noise double, month double")
    return df


def test_gbt_and_rf_on_planted_signal(spark):
    df = planted(spark)
    names = ["decline_rate", "noise", "month"]
    train = M.with_class_weights(df.where(F.col("merchant_id") % 5 != 0))
    test = df.where(F.col("merchant_id") % 5 == 0)
    keep = ["merchant_id", "week_start_date", F.col("label").cast("int").alias("y_true")]
    for pipe in (M.gradient_boosting(names), M.random_forest(names)):
        model = pipe.fit(train)
        p1 = M.score(model, test, keep)
        assert p1.count() == test.count()
        lo, hi = p1.agg(F.min("score"), F.max("score")).first()
        assert 0.0 <= lo <= hi <= 1.0
        auc = EV.roc_auc_average_precision(p1).first()["roc_auc"]
        assert auc > 0.6
        p2 = M.score(pipe.fit(train), test, keep)
        a = sorted((r["merchant_id"], r["score"]) for r in p1.collect())
        b = sorted((r["merchant_id"], r["score"]) for r in p2.collect())
        assert a == b


def test_grouped_auc_matches_single(spark):
    df = planted(spark, n=400).withColumn("g", (F.col("merchant_id") % 3).cast("int")).select(
        "g", "merchant_id", "week_start_date", F.col("label").cast("int").alias("y_true"),
        F.round("decline_rate", 2).alias("score"))
    grouped = {r["g"]: r["roc_auc"] for r in M.grouped_auc(df, ["g"]).collect()}
    for g in range(3):
        single = EV.roc_auc_average_precision(df.where(F.col("g") == g)).first()["roc_auc"]
        assert abs(grouped[g] - single) < 1e-12


@pytest.fixture(scope="module")
def small_run(spark):
    """A run on sf0.001 with small settings, its metrics left as they are."""
    forest, boosting = dict(M.RF_PARAMS), dict(M.GBT_PARAMS)
    M.RF_PARAMS.update(numTrees=10)
    M.GBT_PARAMS.update(maxIter=5)
    yield M.TrainRun(Tables.from_raw(spark, SF_SMALL))
    M.RF_PARAMS.update(forest)
    M.GBT_PARAMS.update(boosting)


@pytest.mark.parametrize("winner", M.MODEL_ORDER)
def test_whichever_model_wins_is_explained_saved_and_used(spark, small_run, monkeypatch, winner):
    run = small_run
    monkeypatch.setattr(run, "best", lambda: winner)
    monkeypatch.setattr(M, "PERMUTATION_REPEATS", 2)
    importance = M.feature_importance(run).collect()
    assert len(importance) == 2 * len(run.names) == 40
    assert {r.importance_type for r in importance} == {M.GINI, M.PERMUTATION}
    base = shared_work_dir(spark, "test-models")
    card = M.model_card(run, run.save(base))
    assert card["best_model"]["name"] == winner and card["best_model"]["metrics"]["model"] == winner
    keep = ["merchant_id", "week_start_date"]
    again = M.load_model(card["best_model"]["path"])
    assert sorted(map(tuple, M.score(again, run.test, keep).collect())) == sorted(
        (r.merchant_id, r.week_start_date, r.score) for r in run.prediction(winner).collect())
    assert M.score_latest_week(run.t, card).count() > 0


def test_permuting_the_signal_costs_most(spark):
    df = planted(spark, n=1200)
    run = M.TrainRun.__new__(M.TrainRun)
    run.names = ["decline_rate", "noise", "month"]
    run.order, run._models, run._predictions = ["knn"], {}, {}
    run.train, run.test = (df.where(F.col("merchant_id") % 4 != 0), df.where(F.col("merchant_id") % 4 == 0))
    drop = {r.feature: r.importance for r in M.permutation_importance(run, "knn").collect()}
    assert drop["decline_rate"] > 0.05 and drop["decline_rate"] == max(drop.values())


def test_search_winner_is_a_candidate(spark, small_run):
    table = small_run.search(recent_weeks=None, max_rows=400, first_rows=100, parallel=2)
    assert table.where("round = 0").count() == len(search.candidates()) and small_run.order[-1] == M.SEARCH
    assert {r.model for r in small_run.metrics().collect()} == {*M.MODEL_ORDER, M.SEARCH}
    small_run.order.remove(M.SEARCH)


def test_candidates_share_medians_and_are_measured_once(spark, small_run, monkeypatch):
    searched, measured = [], []
    fit, metrics = M.MedianImputer._fit, EV.model_metrics
    monkeypatch.setattr(M.MedianImputer, "_fit", lambda self, df: searched.append(1) or fit(self, df))
    monkeypatch.setattr(EV, "model_metrics", lambda scored, name: measured.append(name) or metrics(scored, name))
    run = M.TrainRun(small_run.t, training=small_run.training)
    best = run.best()
    card = M.model_card(run, {m: m for m in run.order})
    assert card["best_model"]["name"] == best and len(searched) == 1 and sorted(measured) == sorted(M.MODEL_ORDER)
    alone = M.gradient_boosting(run.names).fit(run.tree_rows())
    keep = ["merchant_id", "week_start_date"]
    assert sorted(map(tuple, M.score(alone, run.test, keep).collect())) == sorted(
        (r.merchant_id, r.week_start_date, r.score) for r in run.prediction("gradient_boosting").collect())


def test_split_contract(spark):
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(weeks=i), 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "merchant_id bigint, week_start_date date, churn_4w double")
    weeks = [r[1] for r in rows]
    assert EV.split_date_value(df) == weeks[11]
    assert EV.split_date_value(df, str(weeks[5])) == weeks[5]
    assert EV.split_date_value(df, "2030-01-01") == EV.split_fallback_quantile_of(df).first()[0] < weeks[-1]
    for bad in (df.limit(0), df.where("merchant_id = 3")):
        with pytest.raises(ValueError):
            EV.split_date_value(bad)
    with pytest.raises(ValueError):
        EV.split_date_value(df, "2020-01-01")
    run = EV.split_stats(df, "churn_4w", str(weeks[5])).collect()
    assert {(r.side, r.rows) for r in run} == {("train", 6), ("test", 14)}


def test_explicit_date_reaches_the_metrics(spark, small_run):
    run = M.TrainRun(small_run.t, train_end_date="1997-06-30", models=["knn"], training=small_run.training)
    row, = M.eval_metrics(run).collect()
    assert str(row.split_date) == "1997-06-30" and row.train_end <= row.split_date < row.test_start
    assert row.test_rows == run.test.count() and row.train_rows == run.train.count()
