"""The forest on bins: its counts, splits and bootstrap by plain means, and Spark's forest beside it."""
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from test_models import planted

from ledgerlens.plans import evaluation as EV
from ledgerlens.plans import forest as FO
from ledgerlens.plans import models as M

NAMES = ["decline_rate", "noise", "month"]


def test_copies_are_a_poisson_bootstrap():
    drawn = FO.copies(42, 3, 0, 0, 200_000)
    assert abs(drawn.mean() - 1) < 0.01 and abs(drawn.var() - 1) < 0.02 and abs((drawn == 0).mean() - np.exp(-1)) < 0.01
    assert (drawn == FO.copies(42, 3, 0, 0, 200_000)).all()
    assert all((drawn != FO.copies(*other, 200_000)).any() for other in ((41, 3, 0, 0), (42, 4, 0, 0), (42, 3, 1, 0), (42, 3, 0, 1)))


def test_edges_of_few_many_and_equal_values():
    assert FO.edges(np.array([5.0, 1.0, 2.0, 2.0]), np.ones(4)).tolist() == [1.5, 3.5]
    assert FO.edges(np.full(9, 3.0), np.ones(9)).size == 0
    x = np.arange(3200.0)
    cuts = FO.edges(x, np.ones(3200))
    assert len(cuts) == FO.BINS - 1 and np.ptp(np.bincount(FO.binned(x[:, None], [cuts])[0])) <= 1
    assert (FO.binned(np.array([[1.5], [1.6], [9.0]]), [np.array([1.5, 3.5])])[0] == [0, 1, 2]).all()


def test_counts_and_splits_match_row_by_row():
    rng = np.random.default_rng(1)
    bins, label = rng.integers(0, FO.BINS, (4, 500)).astype(np.uint8), rng.integers(0, 2, 500).astype(np.uint8)
    drawn = FO.copies(1, 0, 0, 0, 500)
    feature, cut, nodes, tried = np.full(8, -1), np.zeros(8, int), np.array([4, 7]), np.array([[2, 0], [3, 1]])
    feature[[1, 2, 3]], cut[[1, 2, 3]] = [0, 1, 2], [15, 10, 20]
    want = np.zeros((2, 2, FO.CODES), int)
    for i in range(500):
        node = 1
        for _ in range(2):
            node = 2 * node + int(bins[feature[node], i] > cut[node])
        for s in np.flatnonzero(nodes == node):
            for j in range(2):
                want[s, j, 2 * bins[tried[s, j], i] + label[i]] += drawn[i]
    got = FO.counted(bins * np.uint8(2) + label, drawn, feature, cut, 2, nodes, tried)
    assert (got == want).all()
    weights = np.array([0.7, 1.9])
    for s, (j, c, gain, left, right) in enumerate(FO.best_splits(want, weights, 20)):
        best = 0.0
        for k in range(2):
            per = want[s, k].reshape(FO.BINS, 2)
            for at in range(FO.BINS - 1):
                a, b = per[:at + 1].sum(axis=0), per[at + 1:].sum(axis=0)
                if min(a.sum(), b.sum()) >= 20:
                    wa, wb, w = (a * weights).sum(), (b * weights).sum(), ((a + b) * weights).sum()
                    best = max(best, FO.gini((a + b) * weights) - wa / w * FO.gini(a * weights) - wb / w * FO.gini(b * weights))
        assert gain == pytest.approx(best) and min(left.sum(), right.sum()) >= 20
        assert (left == want[s, j].reshape(FO.BINS, 2)[:c + 1].sum(axis=0)).all()


def test_forest_agrees_with_sparks(spark):
    """Other draws, the same model: probabilities close by, the same importances and rank of the signal."""
    df = planted(spark, n=6000)
    train, test = M.with_class_weights(df.where("merchant_id % 5 != 0")), df.where("merchant_id % 5 = 0")
    ours = M.random_forest(NAMES).fit(train)
    spark_forest = RandomForestClassifier(labelCol="label", weightCol="weight", seed=M.SEED, **{**M.RF_PARAMS, "numTrees": 100}).fit(
        VectorAssembler(inputCols=NAMES, outputCol="features").transform(train))
    keep = ["merchant_id", F.col("label").cast("int").alias("y_true")]
    a = M.score(ours, test, keep)
    b = M.score(spark_forest, VectorAssembler(inputCols=NAMES, outputCol="features").transform(test), keep)
    x, y = (np.array([r.score for r in s.orderBy("merchant_id").collect()]) for s in (a, b))
    assert np.abs(x - y).mean() < 0.02 and np.corrcoef(x, y)[0, 1] > 0.99
    auc = [EV.roc_auc_average_precision(s.withColumn("week_start_date", F.current_date())).first()["roc_auc"] for s in (a, b)]
    assert abs(auc[0] - auc[1]) < 0.01
    assert np.abs(ours.stages[-1].featureImportances.toArray() - spark_forest.featureImportances.toArray()).max() < 0.03


def test_all_rows_reach_the_chunks(spark, monkeypatch):
    monkeypatch.setattr(FO, "CHUNK", 100)
    rows = spark.range(0, 1234, 1, 3).selectExpr("array(double(id % 7), double(id)) x", "int(id % 2) label")
    packed = FO.chunks(rows, [np.arange(6) + 0.5, np.array([600.5])]).collect()
    codes = np.concatenate([np.frombuffer(r.codes, np.uint8).reshape(2, -1) for r in packed], axis=1)
    assert len({(r.part, r.number) for r in packed}) == len(packed) > 10
    assert sorted(map(tuple, codes.T.tolist())) == sorted((2 * (i % 7) + i % 2, 2 * (i > 600) + i % 2) for i in range(1234))


def test_levels_read_one_written_table_dealt_evenly(spark, monkeypatch):
    """Rows of one partition go to many files, each of them a task; every level reads these and nothing of a row in between."""
    monkeypatch.setattr(FO, "CHUNK", 50)
    monkeypatch.setattr(FO, "CORE_FILES", 1)
    read, real = [], FO._level
    monkeypatch.setattr(FO, "_level", lambda packed, *rest: read.append(packed) or real(packed, *rest))
    train = M.with_class_weights(planted(spark, n=3000).coalesce(1))
    forest = FO.ForestClassifier(numTrees=3, maxDepth=4).fit(VectorAssembler(inputCols=NAMES, outputCol="features").transform(train))
    assert len(read) == 4 and len({id(p) for p in read}) == 1 and forest.trees.counts[:, 1].sum(axis=1).min() > 2700
    per_file = [n for n in read[0].rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(per_file) == min(60, spark.sparkContext.defaultParallelism) and max(per_file) - min(per_file) <= 1


def test_labels_and_weights_are_checked(spark):
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(planted(spark, n=50))
    for bad in (rows.limit(0).withColumn("weight", F.lit(1.0)), rows.withColumn("weight", F.col("noise")),
                rows.withColumn("label", F.lit(2.0)).withColumn("weight", F.lit(1.0))):
        with pytest.raises(ValueError):
            FO.ForestClassifier().fit(bad)


def test_one_class_is_one_leaf(spark):
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(planted(spark, n=50).withColumn("label", F.lit(1.0)))
    model = FO.ForestClassifier(numTrees=3).fit(rows.withColumn("weight", F.lit(0.5)))
    assert {r.score for r in M.score(model, rows, []).collect()} == {1.0} and not model.featureImportances.toArray().any()
