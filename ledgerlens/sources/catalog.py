"""Catalog tables over a loaded warehouse, and bucketed tables of features.

Tables are made by CREATE TABLE ... USING parquet from the declared schemas, over the
files of a load; nothing is copied. They live in the session's catalog.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .fixtures import Tables

DATABASE = "payments"
PARTITIONS = {"transactions": ["partition_year", "partition_month"]}


def create_database(spark: SparkSession, base: str, database: str = DATABASE) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base.rstrip('/')}/{database}.db'")


def table_ddl(name: str, location: str, database: str = DATABASE) -> str:
    """The CREATE TABLE statement of a declared table over files at ``location``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.SCHEMAS[name].fields)
    parts = f" PARTITIONED BY ({', '.join(PARTITIONS[name])})" if name in PARTITIONS else ""
    return f"CREATE TABLE {database}.{name} ({columns}) USING parquet{parts} LOCATION '{location}'"


def create_tables(t: Tables, base: str, database: str = DATABASE) -> list[str]:
    """The four declared tables: three over the files of a loaded warehouse, campaigns empty."""
    spark = t.spark
    if t.folder is None:
        raise ValueError("catalog tables are made over a loaded warehouse")
    create_database(spark, base, database)
    made = []
    for name in schemas.SCHEMAS:
        location = f"{t.folder}/{name}" if name != "campaigns" else f"{base.rstrip('/')}/{database}.db/campaigns"
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")  # external: the files stay
        spark.sql(table_ddl(name, location, database))
        if name in PARTITIONS:
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
        made.append(f"{database}.{name}")
    return made


def write_bucketed(df: DataFrame, table: str, path: str, key: str, order: list[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table at ``path`` in ``buckets`` files by ``key``, sorted, and read it as a table.

    Readers that group or window by ``key`` need no exchange.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(*order).option("path", path).saveAsTable(table)
    return spark.table(table)
