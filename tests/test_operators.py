"""Global ordering operator vs plain windows; exact KNN vs brute force."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import dense_rank_by_value, global_order


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_global_order_matches_window(spark, parts):
    rnd = random.Random(parts)
    data = [(i, rnd.choice([None, 1.0, 2.0, 2.0, 3.5, 7.0]), rnd.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(data, "id bigint, v double, w int")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = global_order(df, order, row_number="rn", running_sums={"cw": "w"}, n_parts=parts)
    ref = df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn_ref"),
                    F.sum("w").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).alias("cw_ref"))
    j = got.join(ref, "id").collect()
    assert len(j) == 500
    assert all(r["rn"] == r["rn_ref"] and r["cw"] == r["cw_ref"] for r in j)


def test_row_numbers_need_one_exchange(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = global_order(df, [F.col("v"), F.col("id")], row_number="rn")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan and "hashpartitioning(v" not in plan


@pytest.mark.parametrize("descending", [True, False])
def test_dense_rank_by_value(spark, descending):
    rnd = random.Random(3)
    data = [(i, rnd.choice([None, 1.0, 2.0, 5.0])) for i in range(300)]
    df = spark.createDataFrame(data, "id bigint, v double")
    w = Window.orderBy(F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last())
    ref = {r["id"]: r["d"] for r in df.select("id", F.dense_rank().over(w).alias("d")).collect()}
    got = {r["id"]: r["dr"] for r in dense_rank_by_value(df, "v", "dr", descending=descending, n_parts=4).collect()}
    assert got == ref


@pytest.mark.parametrize("scale", [2, 6])
def test_money_sum_of_a_group_beyond_a_long(spark, scale):
    from decimal import Decimal

    from ledgerlens.functions import exprs as X
    values = [Decimal(9 * 10 ** (17 - scale)) + Decimal(i).scaleb(-scale) for i in range(40)] + [Decimal(-1).scaleb(-scale)]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, None)], f"k int, amount decimal(18,{scale})")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(X.money_sum("amount", scale=scale).alias("s")).collect()}
    assert got == {1: sum(values), 2: None} and sum(values).scaleb(scale) > 2 ** 63


def test_knn_exact_against_brute_force(spark, tmp_path):
    from ledgerlens.plans.knn import KnnModel

    rnd = np.random.default_rng(0)
    n_tr, n_te = 120, 15
    x_tr = rnd.normal(size=(n_tr, 3)).round(1)
    y_tr = (rnd.random(n_tr) < 0.4).astype(float)
    x_te = np.vstack([x_tr[:2], rnd.normal(size=(n_te - 2, 3)).round(1)])  # two exact matches
    base = dt.date(2024, 1, 1)
    tr = spark.createDataFrame([(i, base, float(y_tr[i]), *map(float, x_tr[i])) for i in range(n_tr)],
                               "merchant_id bigint, week_start_date date, label double, a double, b double, c double")
    te = spark.createDataFrame([(1000 + i, base, 0.0, *map(float, x_te[i])) for i in range(n_te)],
                               "merchant_id bigint, week_start_date date, label double, a double, b double, c double")
    model = KnnModel.fit(tr, ["a", "b", "c"], k=5)
    got = {r["merchant_id"]: r["score"] for r in model.score(te, ["merchant_id"]).collect()}
    model.save(spark, f"{tmp_path}/knn")
    again = KnnModel.load(spark, f"{tmp_path}/knn")
    assert got == {r["merchant_id"]: r["score"] for r in again.score(te, ["merchant_id"]).collect()}
    mu, sd = x_tr.mean(axis=0), x_tr.std(axis=0)
    ztr, zte = (x_tr - mu) / sd, (x_te - mu) / sd
    for i in range(n_te):
        dist = np.sqrt(((ztr - zte[i]) ** 2).sum(axis=1))
        nn = np.argsort(dist, kind="stable")[:5]
        if (dist[nn] == 0).any():
            w = (dist[nn] == 0).astype(float)
        else:
            w = 1 / dist[nn]
        assert got[1000 + i] == pytest.approx((w * y_tr[nn]).sum() / w.sum(), abs=1e-9)


def test_knn_keeps_a_bounded_sample(spark):
    from ledgerlens.plans.knn import KnnModel

    tr = spark.range(5000).selectExpr("id AS merchant_id", "date'2024-01-01' AS week_start_date", "cast(id % 2 AS double) AS label",
                                      "cast(id % 10 AS double) AS a")
    assert 700 < len(KnnModel.fit(tr, ["a"], max_rows=1000).rows) < 1300
    assert len(KnnModel.fit(tr, ["a"], max_rows=5000).rows) == 5000


def test_written_tables_are_removed(spark):
    from ledgerlens.operators.lineage import materialize, written_tables_removed

    kept = materialize(spark.range(3), "kept")
    with written_tables_removed(spark):
        gone = materialize(spark.range(4), "gone").inputFiles()[0]
        assert spark.read.parquet(gone).count() >= 0
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)
