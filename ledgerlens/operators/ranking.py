"""Global ordering without pulling all rows into one task.

An unpartitioned window (``Window.orderBy(...)``) sends every row to one task.
``global_order`` range-partitions on the order keys instead, sorts inside the
ranges and numbers rows with ``monotonically_increasing_id``, whose high bits
are the range and whose low bits the place in it; a table with one row per range
(as many as there are partitions, so it is broadcast) turns that into a global
row number. Row numbers need one exchange; running sums one more, by range.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import materialize

#: monotonically_increasing_id has the partition above and the row below this many bits.
PLACE_BITS = 33


def global_order(df: DataFrame, order: list[Column], *, row_number: str | None = None,
                 running_sums: dict[str, str] | None = None, n_parts: int | None = None) -> DataFrame:
    """Add a global row_number and inclusive running sums over ``order``.

    ``running_sums`` maps output name -> numeric column. The order keys must be
    unique for a repeatable result. The input is written once first (a no-op for
    a written table): range partitioning samples it in a job of its own.
    """
    running_sums = running_sums or {}
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df, "order-input").repartitionByRange(n, *order).sortWithinPartitions(*order)
    # Written once: the rows and the totals per range must see the same ranges.
    local = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "order")
    local = local.withColumn("_range", F.shiftright("_at", PLACE_BITS))
    totals = local.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{o}") for o, c in running_sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                            *[F.sum(f"_t_{o}").over(before).alias(f"_off_{o}") for o in running_sums])
    if running_sums:
        upto = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for out, c in running_sums.items():
            local = local.withColumn(f"_sum_{out}", F.sum(c).over(upto))
    result = local.join(F.broadcast(offsets), "_range")
    if row_number:
        place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
        result = result.withColumn(row_number, (F.col("_before") + place + 1).cast("bigint"))
    for out in running_sums:
        own, off = F.col(f"_sum_{out}"), F.col(f"_off_{out}")
        result = result.withColumn(out, F.when(off.isNull(), own).otherwise(own + off))
    return result.drop("_at", "_range", "_before", *[f"_{k}_{o}" for o in running_sums for k in ("sum", "off")])


def dense_rank_by_value(df: DataFrame, value: str, out: str, *, descending: bool = True,
                        n_parts: int | None = None) -> DataFrame:
    """DENSE_RANK over one column, NULLs last.

    The distinct values are ranked (one row per value, so no range is hot) and
    joined back on one row per value, so Spark can split the rows of a hot value.
    Rows without a value take the rank after the last and are not joined. The
    input is written once, as it is read for the values and for the rows.
    """
    df = materialize(df, "rank-input")
    some = df.where(F.col(value).isNotNull())
    values = materialize(some.select(F.col(value).alias("_v")).distinct(), "rank-values")
    ranked = global_order(values, [F.col("_v").desc() if descending else F.col("_v").asc()], row_number=out, n_parts=n_parts)
    last = F.lit(values.count() + 1).cast("bigint")
    joined = some.join(ranked, F.col(value) == F.col("_v")).drop("_v")
    return joined.unionByName(df.where(F.col(value).isNull()).withColumn(out, last))
