"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length: a bucket holds the lengths within one part of an
octave. A bucket is split by direction, to the nearest of some pivots, and what has
many rows is dealt to blocks of a bounded number. A lower bound of each query's k-th
best score comes from a bounded sample of the rows, as do the pivots. A bucket's part
of a pivot takes part for a query only if the product of the lengths and the widest
cosine that its rows can have with the query reach that bound. Queries are dealt to
blocks by their own pivot, and a block of rows is sent only to the blocks of queries
that ask for it. Inside a block the bound becomes a cosine threshold. Where the
threshold is high, candidates are pruned by coordinates (the values the
query's largest coordinates allow); where it is low, by length. What is left
is verified by its integer product. The sample only sets the bound; every row
is a candidate.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, record_batch

SCALE = 256
K = 5
BUCKETS_PER_OCTAVE = 8
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Rows whose scores give the first bound of each query.
SEED_ROWS = 2048
FOCUS = 8
#: Directions that split the buckets.
PIVOTS = 64
#: From this cosine on, candidates are pruned by coordinates.
COORDINATES_FROM = 0.3

BOUND_DDL = "query_id bigint, q array<bigint>, dim int, q_norm double, bound double"
BOUND = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("dim", pa.int32()), ("q_norm", pa.float64()),
                   ("bound", pa.float64())])
PLACED_DDL = "vec_id bigint, q array<bigint>, dim int, norm double, bucket int, cell int, cosine double"
PLACED = pa.schema([("vec_id", pa.int64()), ("q", pa.list_(pa.int64())), ("dim", pa.int32()), ("norm", pa.float64()), ("bucket", pa.int32()),
                    ("cell", pa.int32()), ("cosine", pa.float64())])
ASKED_DDL = "dim int, bucket int, cell int, part int, block bigint, query_id bigint, q array<bigint>, bound double"
ASKED = pa.schema([("dim", pa.int32()), ("bucket", pa.int32()), ("cell", pa.int32()), ("part", pa.int32()), ("block", pa.int64()),
                   ("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("bound", pa.float64())])
ASKED_ROWS = 10_000
HITS_DDL = "query_id bigint, vec_id bigint, score bigint"
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, q (floor(scale * x) of each component), dim, norm, bucket; without null or non-finite vectors."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where("embedding is not null").where(finite)
    rows = rows.select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("bigint")).alias("q"))
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    rows = rows.select("vec_id", "q", F.size("q").alias("dim"), norm.alias("norm"))
    bucket = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * BUCKETS_PER_OCTAVE).cast("int")).otherwise(-1)
    return rows.withColumn("bucket", bucket)


def _matrix(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of a with those of b; saturated at 64 bits."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1]) if a.size and b.size else 0
    if top < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def directions(q: np.ndarray) -> np.ndarray:
    x = q.astype(float)
    norms = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norms > 0, norms, 1)[:, None]


def pivots_of(unit: np.ndarray, most: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from all before."""
    if not len(unit):
        return unit
    taken, nearest = [0], unit @ unit[0]
    while len(taken) < min(most, len(unit)) and nearest.min() < 1 - 1e-9:
        taken.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[taken[-1]])
    return unit[taken]


def _place(batches, pivots):
    """cell, the nearest pivot of each row, and the cosine with it."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        cell, cosine = np.zeros(len(dims), np.int32), np.full(len(dims), -1.0)
        for dim in set(dims.tolist()) & pivots.keys():
            own = np.flatnonzero(dims == dim)
            near = directions(_matrix(batch.column("q").take(pa.array(own)), dim)) @ pivots[dim].T
            cell[own], cosine[own] = near.argmax(axis=1), near.max(axis=1)
        yield record_batch(PLACED, [*(batch.column(c) for c in ("vec_id", "q", "dim", "norm", "bucket")), cell, cosine])


def _asked(batches, stats, pivots, cells_of_queries):
    """One row for each query and part of the rows that may hold one of its best."""
    for batch in batches:
        out = []
        for query_id, q, dim, q_norm, bound in zip(*(batch.column(c).to_pylist() for c in ("query_id", "q", "dim", "q_norm", "bound")), strict=True):
            if dim not in stats:
                continue
            bucket, cell, parts, longest, radius = stats[dim]
            near = np.clip(pivots[dim] @ directions(np.array([q], np.int64).reshape(1, dim))[0], -1, 1) if dim in pivots else np.zeros(1)
            widest = np.cos(np.maximum(0, np.arccos(near[cell]) - radius))
            reach = q_norm * longest * np.where(widest >= 0, widest, 0) if bound > 0 else np.full(len(cell), np.inf)
            own = int(near.argmax())
            block = own << 32 | int(xxhash.xxh3_64_intdigest(str(query_id))) % cells_of_queries.get((dim, own), 1)
            for t in np.flatnonzero(bound <= reach * (1 + 1e-9) + 1e-6).tolist():
                out += [(dim, int(bucket[t]), int(cell[t]), p, block, query_id, q, bound) for p in range(int(parts[t]))]
                if len(out) >= ASKED_ROWS:
                    yield record_batch(ASKED, zip(*out, strict=True))
                    out = []
        if out:
            yield record_batch(ASKED, zip(*out, strict=True))


def _bounds(batches, seeds, k):
    """The k-th best score of each query among the seeds of its dimension."""
    for batch in batches:
        ids, dims = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        out = np.full(len(ids), -np.inf)
        for dim in set(dims.tolist()) & seeds.keys():
            rows = np.flatnonzero(dims == dim)
            seed_ids, known, matrix = seeds[dim]
            scores = products(_matrix(batch.column(1).take(pa.array(rows)), dim), matrix).astype(float)
            scores[known[None, :] & (seed_ids[None, :] == ids[rows, None])] = -np.inf
            if scores.shape[1] >= k:
                out[rows] = np.partition(scores, -k, axis=1)[:, -k]
        yield record_batch(BOUND, [*batch.columns[:4], out])


def feasible(unit: np.ndarray, order: dict, q: np.ndarray, cosine: float, focus: int) -> np.ndarray:
    """Rows of unit vectors whose values at the query's largest coordinates, each and together, allow that cosine."""
    rows, tests = None, []
    for f in np.argsort(-np.abs(q), kind="stable")[:focus].tolist():
        reach = np.sqrt(max(0.0, 1 - q[f] * q[f]) * max(0.0, 1 - cosine * cosine)) + 1e-9
        low, high = q[f] * cosine - reach, q[f] * cosine + reach
        if q[f] >= cosine:
            high = np.inf
        if -q[f] >= cosine:
            low = -np.inf
        if f not in order:
            by = np.argsort(unit[:, f], kind="stable")
            order[f] = by, unit[by, f]
        by, values = order[f]
        own = by[np.searchsorted(values, low, "left"):np.searchsorted(values, high, "right")]
        tests.append((f, low, high))
        if rows is None or len(own) < len(rows):
            rows = own
    for f, low, high in tests:
        at = unit[rows, f]
        rows = rows[(at >= low) & (at <= high)]
    own = [f for f, _, _ in tests]
    part, mine = unit[np.ix_(rows, own)], q[own]
    left = np.sqrt(np.maximum(0, 1 - mine @ mine) * np.maximum(0, 1 - (part * part).sum(axis=1)))
    return rows[part @ mine + left >= cosine - 1e-9]


def search_block(cand_ids: list, cands: np.ndarray, query_ids: list, queries: np.ndarray, bounds: np.ndarray, k: int,
                 coordinates_from: float = COORDINATES_FROM, focus: int = FOCUS) -> list[tuple]:
    """(query_id, vec_id, score) of each query's k best candidates of this block that reach its bound."""
    ids = np.array([np.iinfo(np.int64).max if i is None else i for i in cand_ids], np.int64)
    null = np.array([i is None for i in cand_ids])
    as_float = cands.astype(float)
    norms = np.sqrt((as_float * as_float).sum(axis=1))
    by_length = np.argsort(-norms, kind="stable")
    sorted_norms = -norms[by_length]
    unit = as_float / np.where(norms > 0, norms, 1)[:, None]
    longest = norms.max(initial=0)
    order: dict = {}
    out = []
    for query_id, q, bound in zip(query_ids, queries, bounds.tolist(), strict=True):
        q_norm = float(np.sqrt((q.astype(float) ** 2).sum()))
        reach = q_norm * longest
        if bound > reach * (1 + 1e-9) + 1e-6:
            continue
        if bound <= 0 or not reach:
            rows = np.arange(len(ids))
        elif (cosine := min(1.0, bound / reach) - 1e-9) >= coordinates_from:
            rows = feasible(unit, order, q / q_norm, cosine, focus)
        else:
            rows = by_length[:np.searchsorted(sorted_norms, -(bound / q_norm) * (1 - 1e-9) + 1e-6, "right")]
        rows = rows[null[rows] | (ids[rows] != query_id)]
        scores = products(cands[rows], q[None, :])[:, 0]
        good = scores >= bound
        rows, scores = rows[good], scores[good]
        if len(rows) > k:
            least = np.partition(scores, -k)[-k]
            rows, scores = rows[scores >= least], scores[scores >= least]
        # Python ints compare the null flag after the id: a null id is the largest.
        for j in np.lexsort((null[rows], ids[rows], -scores.astype(object)))[:k].tolist():
            out.append((query_id, cand_ids[rows[j]], int(scores[j])))
    return out


def tiles(placed: DataFrame, bounded: DataFrame, pivots: dict, block_rows: int, query_rows: int) -> tuple[DataFrame, DataFrame]:
    """Queries by (dim, bucket, cell, part, block) that they ask, and rows sent to the blocks that ask for their part."""
    # One row for each dimension, part of an octave and pivot: some thousands for any number of vectors.
    by_cell = placed.groupBy("dim", "bucket", "cell").agg(
        F.max("norm").alias("longest"), F.min("cosine").alias("cosine"), F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    stats: dict[int, tuple] = {}
    for dim, own in by_cell.toPandas().groupby("dim"):
        radius = np.arccos(np.clip(own["cosine"].to_numpy(), -1, 1)) + 1e-6
        stats[int(dim)] = (own["bucket"].to_numpy(), own["cell"].to_numpy(), own["parts"].to_numpy(), own["longest"].to_numpy(), radius)
    # Blocks of queries of each pivot, so that a block asks for few parts.
    asking = bounded.select(F.col("query_id").alias("vec_id"), "q", "dim", F.col("q_norm").alias("norm"), F.lit(0).alias("bucket")).mapInArrow(
        lambda it: _place(it, pivots), PLACED_DDL).groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    blocks = {(r.dim, r.cell): -(-r.n // query_rows) for r in asking}
    asked = materialize(bounded.mapInArrow(lambda it: _asked(it, stats, pivots, blocks), ASKED_DDL), "asked")
    at = ["dim", "bucket", "cell", "part"]
    wanted = asked.select(*at, "block").distinct()
    parts = F.broadcast(by_cell.select("dim", "bucket", "cell", "parts"))
    dealt = placed.join(parts, ["dim", "bucket", "cell"]).select(
        "dim", "bucket", "cell", F.pmod(F.xxhash64("vec_id", "q"), "parts").cast("int").alias("part"), "vec_id", "q").join(wanted, at)
    return asked, dealt.select(*[F.col(c).alias(c) for c in (*at, "block", "vec_id", "q")])


def top_k(vectors: DataFrame, every: int = 50, k: int = K, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS, seed_rows: int = SEED_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for each vec_id divisible by ``every``.

    Ties go to the smaller vec_id (null last). Vectors that are null or hold a
    null or non-finite component take no part; vectors of different dimension
    have no product. A vec_id is one query: of rows that share it the smallest
    vector asks, and none of them answers it. Repeated rows of another vec_id
    each answer. Scores saturate at 64 bits. An empty table gives no rows; other
    columns are not read.
    """
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors, scale), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min(F.struct("q", "dim", "norm")).alias("v")).select("query_id", "v.q", "v.dim", F.col("v.norm").alias("q_norm"))

    # At most seed_rows vectors come to the driver.
    sample = rows.select("vec_id", "q", "dim").orderBy(F.xxhash64("vec_id", "q"), "vec_id").limit(seed_rows).collect()
    seeds = {}
    for dim in {r.dim for r in sample}:
        own = [r for r in sample if r.dim == dim]
        seeds[dim] = (np.array([r.vec_id or 0 for r in own], np.int64), np.array([r.vec_id is not None for r in own]),
                      np.array([r.q for r in own], np.int64).reshape(len(own), dim))
    bounded = materialize(queries.mapInArrow(lambda it: _bounds(it, seeds, k), BOUND_DDL), "queries")

    pivots = {dim: pivots_of(directions(matrix), PIVOTS) for dim, (_, _, matrix) in seeds.items()}
    placed = materialize(rows.mapInArrow(lambda it: _place(it, pivots), PLACED_DDL), "placed")
    asked, dealt = tiles(placed, bounded, pivots, block_rows, query_rows)

    def search(key, cands: pa.Table, asks: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        found = []
        if cands.num_rows and asks.num_rows:
            found = search_block(
                cands.column("vec_id").to_pylist(), _matrix(cands.column("q").combine_chunks(), dim),
                asks.column("query_id").to_pylist(), _matrix(asks.column("q").combine_chunks(), dim),
                asks.column("bound").to_numpy(), k)
        return pa.Table.from_batches([record_batch(HITS, zip(*found, strict=True) if found else [[]] * 3)])

    keys = ["dim", "bucket", "cell", "part", "block"]
    hits = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, HITS_DDL)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
