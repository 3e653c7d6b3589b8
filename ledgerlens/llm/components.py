"""Connected components of a table of edges: forests of parts, then alternating stars."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, materialize, record_batch

#: Edges one task joins with a forest in memory.
EDGES_AT_ONCE = 200_000

STARS_DDL = "u bigint, v bigint"
STARS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


class Forest:
    """Which nodes are connected, the smallest of each set as its root, and the edges that connected them."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        top = x
        while (up := self.parent.setdefault(top, top)) != top:
            top = up
        while (up := self.parent[x]) != top:
            self.parent[x] = top
            x = up
        return top

    def add(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((a, b))


def _stars(batches):
    """The edges of one part as (node, root) of each of its nodes; a root comes with itself."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.add(a, b)
    nodes = list(forest.parent)
    yield record_batch(STARS, [nodes, [forest.find(x) for x in nodes]])


def components(edges: DataFrame, edges_at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node that can be reached.

    Each part of a bounded number of edges is joined in memory and becomes
    stars. Several parts are joined by large and small stars in turn (every node's
    neighbours go to the smallest of them) until nothing changes. Each round is
    written, so lineage stays short. A round is an aggregate per node joined back
    to the edges, so the neighbours of a node are never gathered.
    """
    given = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "edges")
    parts = -(-given.count() // edges_at_once)
    stars = materialize(given.coalesce(max(1, parts)).mapInArrow(_stars, STARS_DDL), "stars")
    drop_written(edges.sparkSession, given)
    if parts <= 1:
        return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    now, signature = stars.where("u <> v").distinct(), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(
            F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        now = materialize(small, "edges")
        new = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == signature:
            break
        signature = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
