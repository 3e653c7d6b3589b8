"""Counts, minima and maxima of written tables from their Parquet footers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import sibling_session

#: The second version of the Parquet source answers these aggregates from footers.
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def aggregate(spark: SparkSession, path: str, *aggregates: Column) -> DataFrame:
    """One row of counts, minima and maxima of columns; no column is read."""
    return sibling_session(spark, SETTINGS).read.parquet(path).agg(*aggregates)


def row_count(spark: SparkSession, path: str) -> int:
    return aggregate(spark, path, F.count(F.lit(1))).first()[0]


def largest(spark: SparkSession, path: str, column: str):
    """The largest value of a column; None without rows."""
    return aggregate(spark, path, F.max(column)).first()[0]
