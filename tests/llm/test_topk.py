import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.llm import topk as T

DDL = "vec_id bigint, embedding array<float>, label int, q int, dim int, bucket int, norm int, part int"


def make(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4, 5) for i, v in rows], DDL)


def brute(rows, every, k):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for query in sorted({i for i, _ in rows if i is not None and i % every == 0}):
        q = min(v for i, v in rows if i == query)
        scores = [(sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != query and len(v) == len(q)]
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(query, r, i, s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def run(df, **kw):
    return sorted((tuple(r) for r in T.top_k(df, **kw).collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("kw", [{}, {"block_rows": 7, "query_rows": 3, "seed_rows": 20}, {"seed_rows": 1}])
def test_random_vectors(spark, kw):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 4])).tolist()) for i in range(150)]
    assert run(make(spark, rows), every=10, **kw) == brute(rows, 10, 5)


def test_edge_rows(spark):
    same = [0.5, 0.25]
    rows = [(0, same), (1, same), (2, same), (2, same), (3, None), (4, [0.1, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (10, [0.0, 0.0]), (None, same), (None, [9.0, 9.0]), (20, [1.0]), (21, [2.0]), (30, []), (31, []), (40, [1.0, 2.0, 3.0]),
            (50, same), (50, [-3.0, 1.0]), (60, [-1.0, -1.0])]
    assert run(make(spark, rows), every=10, block_rows=2, query_rows=2) == brute(rows, 10, 5)
    assert run(make(spark, [])) == []
    assert run(make(spark, [(0, same)])) == []


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.lists(st.sampled_from([-1.0, 0.0, 0.004, 0.5, 1.0]), min_size=3, max_size=3)), max_size=40),
       st.integers(1, 6))
def test_any_rows(spark, rows, k):
    assert run(make(spark, rows), every=3, k=k, block_rows=5, seed_rows=8) == brute(rows, 3, k)


def test_coordinate_and_length_pruning_agree_with_all_products():
    rng = np.random.default_rng(2)
    cands = rng.integers(-300, 300, (500, 16)) * rng.integers(1, 4, (500, 1))
    queries = rng.integers(-300, 300, (20, 16))
    cands[:100] = queries[rng.integers(0, 20, 100)] + rng.integers(-40, 40, (100, 16))
    scores = T.products(queries, cands)
    bounds = np.sort(scores, axis=1)[:, -5].astype(float)
    args = list(range(1000, 1500)), cands, list(range(20)), queries, bounds, 5
    want = [(i, 1000 + j, int(scores[i, j])) for i in range(20) for j in np.lexsort((np.arange(500), -scores[i]))[:5]]
    for at in (-2, 0.3, 2):
        assert sorted(T.search_block(*args, coordinates_from=at)) == sorted(want)


def test_coordinates_prune_most_candidates():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(2000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    assert len(T.feasible(unit, {}, unit[7], 0.9, 8)) < 400


def test_large_values_are_exact():
    a, b = np.array([[1 << 40, 3]]), np.array([[1 << 20, 1], [1 << 40, 1]])
    assert T.products(a, b).tolist() == [[(1 << 60) + 3, (1 << 63) - 1]]


def test_rows_go_only_to_blocks_that_ask(spark):
    """On clustered vectors the rows sent grow with the table, not with its square."""
    sent = {}
    for n in (1500, 3000):
        rng = np.random.default_rng(8)
        centers = rng.normal(size=(24, 16))
        rows = [(i, (centers[i % 24] + 0.02 * rng.normal(size=16)).tolist()) for i in range(n)]
        vectors = make(spark, rows)
        kw = {"every": 10, "block_rows": 64, "query_rows": 8, "seed_rows": 600}
        placed = []
        tiles = T.tiles
        try:
            T.tiles = lambda *a: placed.append(tiles(*a)) or placed[-1]
            assert run(vectors, **kw) == brute(rows, 10, 5)
        finally:
            T.tiles = tiles
        asked, dealt = placed[0]
        sent[n] = dealt.count()
        blocks = -(-n // 10 // 8)
        assert sent[n] < n * blocks / 8  # sent to all blocks it would be n * blocks
        assert dealt.groupBy("dim", "bucket", "cell", "part").agg({"vec_id": "count"}).count() >= 24
    assert sent[3000] < 5 * sent[1500]


def test_pivots_are_far_from_each_other():
    unit = T.directions(np.array([[1, 0], [1, 0], [0, 5], [-3, 0], [1, 1]]))
    assert len(T.pivots_of(unit, 10)) == 4 and T.pivots_of(unit, 2).tolist() == [[1, 0], [-1, 0]]
    assert T.pivots_of(unit[:0], 3).shape == (0, 2)
