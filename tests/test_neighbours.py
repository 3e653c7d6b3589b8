"""Hashed nearest neighbours: exact form against brute force, recall of the tables."""
import os

import numpy as np
import pytest
from helpers import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens.plans import evaluation as EV
from ledgerlens.plans import features as FT
from ledgerlens.plans import models as M
from ledgerlens.plans import neighbours as N
from ledgerlens.session import shared_work_dir, sibling_session
from ledgerlens.sources.fixtures import Tables


def frame(spark, x, y):
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, float(label), *map(float, v)) for i, (v, label) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "row bigint, label double, " + ", ".join(f"{n} double" for n in names)), names


def brute(x, y, q, k):
    """Votes by sorting all distances; equal vectors are one entry with their mean label."""
    entries, place, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    mean = np.bincount(place.ravel(), y) / n
    out = []
    for v in q:
        d = np.round(np.sqrt(((entries - v) ** 2).sum(axis=1)), 12)
        left, same, weights = k, [], []
        for e in np.argsort(d, kind="stable"):
            rows = min(left, n[e])
            if rows == 0:
                break
            left -= rows
            (same if d[e] == 0 else weights).append((rows if d[e] == 0 else rows / d[e], mean[e]))
        used = np.array(same or weights)
        out.append((used[:, 0] * used[:, 1]).sum() / used[:, 0].sum())
    return np.array(out)


@pytest.mark.parametrize("block", [4096, 50])
def test_exact_form_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(300, 4)), np.zeros((200, 4)), rng.normal(size=(20, 4)).repeat(4, axis=0)])
    y = (rng.random(len(x)) < 0.3).astype(float)
    train, names = frame(spark, x, y)
    q = np.concatenate([rng.normal(size=(40, 4)), np.zeros((5, 4)), x[:10]])
    test, _ = frame(spark, q, np.zeros(len(q)))
    model = N.HashedKnn.fit(train, names, window=None)
    got = {r.row: r.score for r in model.score(test, ["row"]).collect()}
    scaled = [(z - model.mean) / model.scale for z in (x, q)]
    want = brute(scaled[0], y, scaled[1], N.NEIGHBOURS)
    assert np.allclose([got[i] for i in range(len(q))], want, atol=1e-9)


def test_fewer_rows_than_neighbours_nulls_and_no_rows(spark):
    train, names = frame(spark, np.array([[0.0, 1], [2, 3]]), [0, 1])
    test = spark.createDataFrame([(1, None, 1.0), (2, 5.0, None)], "row bigint, c0 double, c1 double")
    model = N.HashedKnn.fit(train, names)
    assert all(0 < r.score < 1 for r in model.score(test, ["row"]).collect())
    assert model.score(test.limit(0), ["row"]).collect() == []
    nothing = N.HashedKnn.fit(train.limit(0), names)
    assert {r.score for r in nothing.score(test, ["row"]).collect()} == {0.0}


def test_recall_of_the_tables(spark):
    """Share of the exact 15 nearest entries that the tables find, on the holdout of the fixture."""
    training = FT.training_table(Tables.from_raw(spark, SF_SMALL))
    train, test = M.split_frames(training)
    model = N.HashedKnn.fit(train, M.feature_names(training), window=60)
    rows = test.select(N.standardised(model.names, model.mean, model.scale).alias("x")).withColumn("id", F.xxhash64("x")).dropDuplicates(["id"])
    rows.cache()
    kth = {r.id: r.near[-1].distance for r in model.exact().near(rows).collect()}
    found = {r.id: [e.distance for e in r.near] for r in model.near(rows).collect()}
    recall = np.mean([sum(d <= kth[i] for d in found[i]) / N.NEIGHBOURS for i in kth])
    assert model.entries.count() > 4 * 60 and recall >= 0.9, recall


def test_window_bounds_the_work_and_hot_vectors_cost_no_more(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 64)
    rng = np.random.default_rng(3)
    x = np.concatenate([np.zeros((2000, 3)), rng.normal(size=(600, 3))])
    train, names = frame(spark, x, np.zeros(len(x)))
    model = N.HashedKnn.fit(train, names, window=16, tables=2)
    assert model.entries.count() == 601
    queries = train.select(N.standardised(names, model.mean, model.scale).alias("x")).withColumn("id", F.xxhash64("x")).dropDuplicates(["id"])
    blocks = model._blocks(queries)
    per = blocks.groupBy("block").agg(F.sum("entry").alias("entries")).agg(F.max("entries")).first()[0]
    assert per <= 64 + 2 * 16 + 2
    assert blocks.where("entry = 0").count() == 2 * 601


def test_saved_form(spark):
    rng = np.random.default_rng(4)
    train, names = frame(spark, rng.normal(size=(200, 3)), rng.integers(0, 2, 200))
    model = N.HashedKnn.fit(train, names)
    path = shared_work_dir(spark, "test-hashed")
    model.save(spark, path)
    again = N.HashedKnn.load(spark, path)
    assert sorted(map(tuple, model.score(train, ["row"]).collect())) == sorted(map(tuple, again.score(train, ["row"]).collect()))


def test_signal_is_found(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3))
    y = (rng.random(1500) < 0.1 + 0.8 * (x[:, 0] > 0)).astype(float)
    df, names = frame(spark, x, y)
    model = N.HashedKnn.fit(df.where("row % 4 != 0"), names)
    scored = model.score(df.where("row % 4 = 0"), [F.col("label").cast("int").alias("y_true")])
    assert EV.roc_auc_average_precision(scored).first()["roc_auc"] > 0.75


def test_orders_carry_no_vectors(spark):
    rng = np.random.default_rng(6)
    train, names = frame(spark, rng.normal(size=(50, 3)), np.zeros(50))
    model = N.HashedKnn.fit(train, names, window=5, tables=2)
    queries = train.select(N.standardised(names, model.mean, model.scale).alias("x")).withColumn("id", F.xxhash64("x"))
    placed = model._placed(model._both(queries))
    assert "x" not in placed.columns and placed.count() == 2 * (50 + 50)


def test_nearest_by_products_is_exact_in_order_of_place():
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(200, 5)) * 1000, np.ones((30, 5)), rng.normal(size=(20, 5)) * 1e-6])
    q = np.concatenate([x[:20], np.ones((2, 5)), np.zeros((2, 5)), rng.normal(size=(20, 5)) * 100])
    for i, (distance, at) in enumerate(N._nearest(x, q, 15)):
        whole = np.round(np.sqrt(((q[i] - x) ** 2).sum(axis=1)), 12)
        want = np.argsort(whole, kind="stable")[:15]
        assert at.tolist() == want.tolist() and distance.tolist() == whole[want].tolist()


def by_places(model, queries):
    """The k nearest of each query among the entries whose places in some order are within the window."""
    both = model._both(queries)
    vectors = {(r.entry, r.id): np.array(r.x) for r in both.collect()}
    placed = model._placed(both).collect()
    out = {}
    for r in (r for r in placed if r.entry == 0):
        near = {e.id for e in placed if e.entry == 1 and e.grid == r.grid and r.upto - model.window < e.upto <= r.upto + model.window}
        out.setdefault(r.id, set()).update(near)
    return {i: sorted((float(np.round(np.sqrt(((vectors[0, i] - vectors[1, e]) ** 2).sum()), 12)), e) for e in near)[:model.k]
            for i, near in out.items()}


@pytest.mark.parametrize("cells, wave", [(16_384, 10_000), (5, 300)])
def test_waves_of_packed_blocks_find_what_the_places_say(spark, monkeypatch, cells, wave):
    for name, value in {"BLOCK": 20, "CELLS": cells, "BLOCK_CELLS": 1, "WAVE_ROWS": wave, "PACK_ROWS": 50}.items():
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(120, 3)), rng.integers(0, 2, (30, 3)) * 1e-3])
    train, names = frame(spark, x, rng.integers(0, 2, len(x)))
    test, _ = frame(spark, np.concatenate([rng.normal(size=(25, 3)), x[:8], np.full((1, 3), 50.0)]), np.zeros(34))
    model = N.HashedKnn.fit(train, names, k=4, window=6, tables=4)
    queries = test.select(N.standardised(names, model.mean, model.scale).alias("x")).withColumn("id", F.xxhash64("x"))
    got = {r.id: [(e.distance, e.id) for e in r.near] for r in model.near(queries).collect()}
    assert got == by_places(model, queries) and len(got) == 34
    blocks = model._blocks(queries)
    assert blocks.where("entry > 0").count() < blocks.agg(F.sum("entry")).first()[0] / 4


def test_a_wave_leaves_neither_its_exchange_nor_the_wave_before(spark, monkeypatch):
    def left():
        base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return {p for p in os.listdir(base) if p.startswith("ledgerlens-knn-near")}
    monkeypatch.setattr(N, "WAVE_ROWS", 200)
    rng = np.random.default_rng(9)
    train, names = frame(spark, rng.normal(size=(200, 3)), np.zeros(200))
    model = N.HashedKnn.fit(train, names, window=5, tables=3)
    before, sessions = left(), []
    monkeypatch.setattr(N, "sibling_session", lambda *a: sessions.append(sibling_session(*a)) or sessions[-1])
    assert model.score(train, ["row"]).count() == 200
    assert len(left() - before) == 1
    assert sessions[0].conf.get(*list(N.SHUFFLES_REMOVED)) == "true"


def test_exact_form_holds_a_tile_and_gathers_no_group(spark, monkeypatch):
    """Every query met every block in a group of its own; now a task has one tile, and k entries of each query at a time."""
    for name, value in {"TILE": 7, "LEAST_TILE": 3, "EXACT_ENTRIES": 11, "EXACT_CELLS": 40}.items():
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(size=(90, 3)) * 1000, rng.integers(0, 3, (40, 3))]).astype(float)
    y = rng.integers(0, 2, len(x)).astype(float)
    train, names = frame(spark, x, y)
    q = np.concatenate([rng.normal(size=(20, 3)) * 1000, x[-5:], rng.integers(0, 3, (10, 3))])
    test, _ = frame(spark, q, np.zeros(len(q)))
    model = N.HashedKnn.fit(train, names, k=6, window=None)
    queries = test.select(N.standardised(names, model.mean, model.scale).alias("x")).withColumn("id", F.xxhash64("x")).dropDuplicates(["id"])
    near = model.near(queries)
    assert "FlatMapGroups" not in near._jdf.queryExecution().executedPlan().toString()
    entries = [(np.array(e.x), e.id) for e in model.entries.collect()]
    for r in queries.join(near, "id").collect():
        want = sorted((float(np.round(np.sqrt(((np.array(r.x) - v) ** 2).sum()), 12)), i) for v, i in entries)[:6]
        assert [e.id for e in r.near] == [i for _, i in want]
        assert np.allclose([e.distance for e in r.near], [d for d, _ in want], rtol=0, atol=1e-11)
