"""Sets of integer keys as bitmaps.

A key set is one row of 32,768 bits for each range of as many keys (``bucket``), so a
fact's keys are reduced to a few rows in each task before anything is shuffled, and
what is shuffled does not grow with the fact. Unions and counts are exact. That suits
keys that lie close together, as generated ids do; ``dense`` asks the dimensions, and
keys outside the dimension's buckets (which are missing for certain) are kept as they are.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_limit

BUCKET_KEYS = 8 * 4096
#: Keys in a bucket from which a bitmap is smaller than its keys.
DENSE = 64
#: Bytes of a row of a bucket table when it is broadcast, at most.
ROW_BYTES = 64


def bucket(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key).cast("bigint"))


def key_bitmaps(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """``by``, bucket and bits of the keys (null keys left out)."""
    rows = df.where(F.col(key).isNotNull()).withColumn("bucket", bucket(key))
    return rows.groupBy(*(by or []), "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key).cast("bigint"))).alias("bits"))


def dense(dims: dict[str, tuple[DataFrame, str]]) -> set[str]:
    """Names of the dimensions whose keys fill the buckets of their range, if those are few enough to be broadcast.

    One job of counts, minima and maxima.
    """
    rows = reduce(DataFrame.unionByName, [dim.agg(F.lit(name).alias("name"), F.count(key).alias("n"), F.min(key).alias("low"),
                                                  F.max(key).alias("high")) for name, (dim, key) in dims.items()])
    limit = broadcast_limit(next(iter(dims.values()))[0].sparkSession)
    found = [(r.name, r.n, (r.high - r.low) // BUCKET_KEYS + 1) for r in rows.collect() if r.n]
    return {name for name, n, buckets in found if n >= DENSE * buckets and buckets * ROW_BYTES <= limit}


def missing_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row: for each name in ``dims`` how many different keys of ``fact`` are not in the dimension; null
    counts as one that is not. The keys of all dimensions are read in one pass over the fact."""
    have = reduce(DataFrame.unionByName, [key_bitmaps(dim.select(key), key).select(F.lit(out).alias("kind"), "bucket", "bits")
                                          for out, (dim, key) in dims.items()])
    keys = F.array(*[F.struct(F.lit(out).alias("kind"), F.col(key).cast("bigint").alias("id")) for out, (_, key) in dims.items()])
    rows = fact.select(F.explode(keys).alias("k")).select("k.kind", "k.id", bucket("k.id").alias("bucket"))
    tagged = rows.join(F.broadcast(have.select("kind", "bucket", F.lit(True).alias("known"))), ["kind", "bucket"], "left")
    # A key outside of the dimension's buckets, or null, is a group of its own.
    stray = F.when(F.col("known").isNull(), F.struct("id"))
    used = tagged.withColumn("stray", stray).groupBy("kind", "bucket", "stray").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    both = used.withColumn("dim", F.lit(0)).unionByName(have.withColumn("dim", F.lit(1)), allowMissingColumns=True)
    per = both.groupBy("kind", "bucket", "stray").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"),
                                                      F.sum(F.when(F.col("dim") == 1, F.bitmap_count("bits")).otherwise(0)).alias("held"))
    missing = F.when(F.col("stray").isNotNull(), 1).otherwise(F.col("all") - F.col("held"))
    return per.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == out, missing)), F.lit(0)).cast("bigint").alias(out) for out in dims])


def repeats(df: DataFrame, key: str) -> bool:
    """Whether any key (not null) occurs in more than one row."""
    counted = df.where(F.col(key).isNotNull()).groupBy(bucket(key)).agg(
        F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key).cast("bigint")))).alias("keys"))
    row = counted.agg(F.sum("rows").alias("rows"), F.sum("keys").alias("keys")).first()
    return (row["rows"] or 0) > (row["keys"] or 0)
