"""Join plans with a checked broadcast side.

A side is broadcast only if the files (or rows) its plan reads are under a
limit of bytes (``ledgerlens.broadcast.maxBytes``, default 32 MB), which Spark's
statistics tell without a job. Beyond the limit
the fact is pre-aggregated on the join key (partial aggregation map-side)
and joined with a shuffle; AQE may still turn that into a broadcast join
from runtime statistics, and splits skewed partitions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 32 << 20


def broadcast_limit(spark) -> int:
    return int(spark.conf.get("ledgerlens.broadcast.maxBytes", str(DEFAULT_MAX_BROADCAST_BYTES)))


def read_bytes(df: DataFrame) -> int:
    """Bytes of all tables the plan of ``df`` reads, by Spark's statistics."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def can_broadcast(tables, name: str) -> bool:
    """Whether a dimension (at most as many rows as its largest input) is small."""
    return read_bytes(tables.table(name)) <= broadcast_limit(tables.spark)


def dimension_side(tables, name: str, df: DataFrame) -> DataFrame:
    """A projection of dimension ``name`` as a join side: broadcast when the
    dimension reads less than the limit, else left to a shuffle join."""
    return F.broadcast(df) if can_broadcast(tables, name) else df


def rollup_through_dimension(tables, fact: DataFrame, dim_name: str, key: str,
                             fact_keys: list[str], dim_keys: list[str],
                             sums: dict[str, Column]) -> DataFrame:
    """Group ``fact`` by fact_keys + attributes of a dimension with additive sums.

    ``sums`` maps output name -> aggregate that can be re-aggregated with SUM
    (sum of a column, count expressed as a sum). The result has columns
    fact_keys + dim_keys + sums.keys().

    Small dimension: broadcast join, then one aggregate (the fact never
    shuffles; the partial aggregate collapses to the output groups).
    Large dimension: aggregate the fact by (key, fact_keys) first, shuffle-join
    the reduced rows with the dimension, then roll up.
    """
    dim = tables.table(dim_name).select(key, *dim_keys)
    if can_broadcast(tables, dim_name):
        joined = fact.join(F.broadcast(dim), key)
        return joined.groupBy(*fact_keys, *dim_keys).agg(
            *[agg.alias(name) for name, agg in sums.items()])
    pre = fact.groupBy(key, *fact_keys).agg(*[agg.alias(name) for name, agg in sums.items()])
    joined = pre.join(dim, key)
    return joined.groupBy(*fact_keys, *dim_keys).agg(
        *[F.sum(name).alias(name) for name in sums])
