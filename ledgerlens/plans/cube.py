"""A cube of KPI cells that answers any set of dashboard filters without the fact.

A cell is a period, channel, payment method, region, industry, merchant size and
bucket of merchant ids; it has the additive sums and the bitmap of its merchants.
Periods are months and days (of one scan), so a date range reads its
whole months as months and only the days at its ends as days. Distinct merchants are
the bits of the cells' union: exact under any filters, which a sum of distinct counts
is not. The number of cells is bounded by the calendar, the categories and the
buckets of merchants, whatever the number of transactions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.joins import dimension_side
from ..operators.keysets import bucket
from ..sources.fixtures import Tables

MERCHANT_DIMS = ["region", "industry", "merchant_size"]
DIMS = ["channel", "payment_method", *MERCHANT_DIMS]
SUMS = ["gpv", "txns", "approved_txns", "amount_total", "amount_n", "fees"]


def kpi_sums() -> dict[str, Column]:
    """The additive sums of the KPI tiles."""
    return {"gpv": X.gpv_sum(), "txns": F.count(F.lit(1)), "approved_txns": X.count_when(X.APPROVED),
            "amount_total": X.money_sum("amount"), "amount_n": F.count("amount"), "fees": X.fee_sum()}


def kpi_tiles(sums: DataFrame) -> DataFrame:
    """The tiles from one row of total sums and active_merchants."""
    return sums.select(X.as_double(F.coalesce("gpv", F.lit(0))).alias("gpv"),
                       F.coalesce(F.col("txns"), F.lit(0)).cast("bigint").alias("txns"),
                       X.safe_div("approved_txns", "txns").alias("approval_rate"),
                       X.mean_from_sums("amount_total", "amount_n").alias("avg_ticket"),
                       X.safe_div("fees", "gpv").alias("fee_yield"), "active_merchants")


def kpi_cube(t: Tables) -> DataFrame:
    """grain (month, day), period, the dimensions, bucket, the sums and bits. The fact is scanned once and
    reduced to merchant and day before it meets the merchants; merchants without a row have no attributes.

    The rows of a cell meet in one exchange by range of the cells' keys, so every bitmap is built once, at its end:
    no partial bitmap is sent, and the cells come out in order.
    """
    daily = t.transactions.groupBy("txn_date", "merchant_id", "channel", "payment_method").agg(*[v.alias(k) for k, v in kpi_sums().items()])
    dim = dimension_side(t, "merchants", t.merchants.select("merchant_id", *MERCHANT_DIMS, F.lit(True).alias("known")))
    grains = F.array(F.struct(F.lit("month").alias("grain"), F.trunc("txn_date", "month").alias("period")),
                     F.struct(F.lit("day").alias("grain"), F.col("txn_date").alias("period")))
    rows = daily.join(dim, "merchant_id", "left").withColumns({"bucket": bucket("merchant_id"), "bit": F.bitmap_bit_position("merchant_id")})
    keys = [*DIMS, "known", "bucket"]
    rows = rows.select(F.inline(grains), *keys, *SUMS, "bit").repartitionByRange("grain", "period", *keys)
    return rows.groupBy("grain", "period", *keys).agg(*[F.sum(c).alias(c) for c in SUMS], F.bitmap_construct_agg("bit").alias("bits"))


def write_cube(t: Tables, path: str) -> DataFrame:
    """The cube as files: one folder for each grain, in order of period."""
    cells = kpi_cube(t)
    cells.write.mode("overwrite").partitionBy("grain").parquet(path, compression="zstd")
    return read_cube(t.spark, path, cells)


def read_cube(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """The written cube, with the schema of ``like`` if it may hold no cell."""
    reader = spark.read if like is None else spark.read.schema(like.schema)
    return reader.parquet(path)


def _whole_month(month: Column, start: str | None, end: str | None) -> Column:
    inside = F.lit(True)
    if start:
        inside = inside & (month >= F.lit(start).cast("date"))
    if end:
        inside = inside & (F.last_day(month) <= F.lit(end).cast("date"))
    return inside


def filtered_kpis(cube: DataFrame, start: str | None = None, end: str | None = None, regions=None, industries=None,
                  sizes=None, channels=None, methods=None) -> DataFrame:
    """KPI tiles under the dashboard's global filters (each optional), from the cube alone."""
    period, is_month = F.col("period"), F.col("grain") == "month"
    if start or end:
        days = F.lit(True)
        if start:
            days = days & (period >= F.lit(start).cast("date"))
        if end:
            days = days & (period <= F.lit(end).cast("date"))
        cells = cube.where((is_month & _whole_month(period, start, end))
                           | (~is_month & days & ~_whole_month(F.trunc("period", "month"), start, end)))
    else:
        cells = cube.where(is_month)
    for name, values in (("region", regions), ("industry", industries), ("merchant_size", sizes), ("channel", channels),
                         ("payment_method", methods)):
        if values:
            cells = cells.where(F.col(name).isin(*values))
    per = cells.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in SUMS], F.bitmap_count(F.bitmap_or_agg("bits")).alias("bits"))
    # Rows without a merchant are one more group, as in a count over merchants.
    merchants = F.coalesce(F.sum(F.when(F.col("bucket").isNull(), 1).otherwise(F.col("bits"))), F.lit(0)).cast("bigint")
    return kpi_tiles(per.agg(*[F.sum(c).alias(c) for c in SUMS], merchants.alias("active_merchants")))


def active_merchants(cube: DataFrame) -> DataFrame:
    """Merchants of the dimension with any transaction."""
    known = cube.where((F.col("grain") == "month") & F.col("known"))
    per = known.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("active_merchants"))
