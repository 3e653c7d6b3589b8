"""Ranking metrics, lift table and scoring rules on hand-made scored frames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import evaluation as EV


def scored(spark, pairs):
    rows = [(i, dt.date(2024, 1, 1), int(y), float(s)) for i, (y, s) in enumerate(pairs)]
    return spark.createDataFrame(rows, "merchant_id bigint, week_start_date date, y_true int, score double")


def test_one_class(spark):
    df = scored(spark, [(0, 0.1 * i) for i in range(20)])
    m = EV.roc_auc_average_precision(df).first()
    assert m["roc_auc"] is None and m["average_precision"] is None
    pk = EV.precision_recall_at_k(df).collect()
    assert all(r["recall"] == 0.0 for r in pk)
    assert all(r["lift"] == 0.0 for r in EV.lift_table(df).collect())


def test_all_scores_tied(spark):
    df = scored(spark, [(i % 4 == 0, 0.5) for i in range(20)])
    m = EV.roc_auc_average_precision(df).first()
    assert m["roc_auc"] == 0.5
    assert m["average_precision"] == pytest.approx(5 / 20)


def test_auc_matches_pairwise_and_flips(spark):
    import random
    rnd = random.Random(7)
    pairs = [(rnd.random() < 0.3, round(rnd.random(), 2)) for _ in range(300)]
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    auc = EV.roc_auc_average_precision(scored(spark, pairs)).first()["roc_auc"]
    assert auc == pytest.approx(brute, abs=1e-12)
    flipped = EV.roc_auc_average_precision(scored(spark, [(y, -s) for y, s in pairs])).first()["roc_auc"]
    assert flipped == pytest.approx(1 - auc, abs=1e-12)


def test_lift_slices(spark):
    df = scored(spark, [(i % 3 == 0, 1 - i / 23) for i in range(23)])
    lt = sorted(EV.lift_table(df).collect(), key=lambda r: r["decile"])
    assert [r["population"] for r in lt] == [3] * 7 + [2]
    assert lt[-1]["cumulative_capture"] == pytest.approx(1.0)
    df7 = scored(spark, [(i == 0, 1 - i / 7) for i in range(7)])
    assert len(EV.lift_table(df7).collect()) == 7


def test_k_at_least_one(spark):
    df = scored(spark, [(i == 0, 1 - i / 20) for i in range(20)])
    r = [x for x in EV.precision_recall_at_k(df).collect() if x["pct"] == 0.01][0]
    assert r["k"] == 1 and r["precision"] == 1.0 and r["recall"] == 1.0


def test_bucket_limits_and_rule_priority(spark):
    df = spark.createDataFrame([(0.8,), (0.6,), (0.4,), (0.39,)], "s double")
    got = [r[0] for r in df.select(EV.risk_bucket(F.col("s"))).collect()]
    assert got == ["critical", "high", "medium", "low"]
    feats = spark.createDataFrame([(0.25, 1.0, 5.0, 0.0), (0.1, 1.0, 0.5, 0.0), (0.1, 100.0, 2.0, 0.95)],
                                  "decline_rate double, gpv double, txn_frequency double, share_card double")
    driver, action = EV.recommendation(F.lit(100.0))
    got = [r[0] for r in feats.select(driver).collect()]
    assert got == ["declines", "volume_drop", "payment_mix"]


def test_exact_median(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 3, 9, 7]], "gpv double")
    assert EV.exact_median(df, "gpv").first()[0] == 4.0
    df2 = spark.createDataFrame([(float(x),) for x in [5, 1, 3]], "gpv double")
    assert EV.exact_median(df2, "gpv").first()[0] == 3.0
