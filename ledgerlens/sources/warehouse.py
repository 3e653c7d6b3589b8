"""Readers and writers: typed full-refresh load, the year=/month= partitioned
fact layout, CSV marts and JSON metrics.

All paths are expected to be shared storage (the bench and tests use folders
under ``spark.checkpoint.dir``).
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import sibling_session
from . import schemas
from .fixtures import Tables


def require_input(spark: SparkSession, path: str, what: str) -> None:
    """Raise FileNotFoundError with a clear message when an input is absent; other faults show when it is read."""
    try:
        spark.read.parquet(path).schema  # noqa: B018  (reads footers only)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"input for {what} missing at {path}") from e
        raise


def typed(df: DataFrame, schema) -> DataFrame:
    """Project and cast to a declared schema (by name)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_observed(writer, df: DataFrame, name: str, aggregates: list) -> dict:
    """Write ``df`` with ``writer`` and return what the write job saw of its rows: their number (``rows``)
    and the aggregates. Nothing is read again; the rows must come from the last stage of the plan,
    as a stage before an exchange may run more than once.

    The write runs in a session of its own with the settings of this one: a session that has observed
    anything can no longer be sent to tasks, which fitted models with a training summary need.
    """
    spark, view = df.sparkSession, f"observed_{uuid.uuid4().hex}"
    other = sibling_session(spark)
    df.createGlobalTempView(view)
    try:
        seen = Observation(name)
        writer(other.table(f"global_temp.{view}").observe(seen, F.count(F.lit(1)).alias("rows"), *aggregates))
        return dict(seen.get)
    finally:
        spark.catalog.dropGlobalTempView(view)


def load_warehouse(t: Tables, path: str, files_per_partition: int | None = None, checks=None,
                   observed: dict[str, dict] | None = None) -> Tables:
    """Full refresh: write typed merchants, customers and the fact (partitioned by
    year and month, sorted by merchant within files) and return Tables over them.

    The three tables are written to a folder of this load, and one rename makes
    them the current ones, so a reader never sees old and new ones mixed. The
    rows of each table, and the aggregates that ``checks`` gives for its name, are
    counted by the write jobs into ``observed``.
    """
    base, load = path.rstrip("/"), f"load-{uuid.uuid4().hex[:12]}"
    observed = {} if observed is None else observed

    def write(name: str, df: DataFrame, *partitions: str) -> None:
        observed[name] = write_observed(lambda rows: rows.write.mode("overwrite").partitionBy(*partitions).parquet(f"{base}/{load}/{name}"),
                                        df, name, checks(name) if checks else [])

    write("merchants", typed(t.merchants, schemas.MERCHANTS))
    write("customers", typed(t.customers, schemas.CUSTOMERS))
    fact = typed(t.transactions, schemas.TRANSACTIONS)
    # Range partitioning on (year, month, merchant) gives balanced write tasks
    # (a month is split across tasks instead of landing in one) and few files
    # per directory; sorting inside files keeps merchant min/max stats tight.
    n = files_per_partition or int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    fact = (fact.repartitionByRange(n, "partition_year", "partition_month", "merchant_id")
            .sortWithinPartitions("partition_year", "partition_month", "merchant_id", "txn_date"))
    write("transactions", fact, "partition_year", "partition_month")
    make_current(t.spark, base, load)
    return Tables.from_warehouse(t.spark, f"{base}/{load}")


CURRENT = "current-"
#: Finished loads that stay.
KEPT_LOADS = 2


def make_current(spark: SparkSession, base: str, load: str) -> None:
    """Name ``load`` the current one: a marker file with its name is put in place by one rename."""
    fs, folder = _file_system(spark, base)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.create(path(folder, f".{load}"), True).close()
    number = 1 + max([int(_marker(f).split("-")[1]) for f in _markers(fs, folder)], default=0)
    if not fs.rename(path(folder, f".{load}"), path(folder, f"{CURRENT}{number:08d}-{load}")):
        raise OSError(f"the load could not become current in {base}")
    # The load before stays for readers that have it open.
    for old in sorted(_marker(f) for f in _markers(fs, folder))[:-KEPT_LOADS]:
        fs.delete(path(folder, old), False)
        fs.delete(path(folder, old.split("-", 2)[2]), True)


def current_load(spark: SparkSession, base: str) -> str | None:
    """The folder of the last load that was finished under ``base``, if there is one."""
    fs, folder = _file_system(spark, base)
    names = sorted(_marker(f) for f in _markers(fs, folder)) if fs.exists(folder) else []
    return f"{base.rstrip('/')}/{names[-1].split('-', 2)[2]}" if names else None


def _file_system(spark: SparkSession, base: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base.rstrip("/"))
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _markers(fs, folder) -> list:
    return [f for f in fs.listStatus(folder) if _marker(f).startswith(CURRENT)]


def _marker(status) -> str:
    return status.getPath().getName()


def write_year_month_layout(df: DataFrame, path: str) -> None:
    """The fact as year=YYYY/month=MM (zero-padded) parquet partitions, replacing the old tree."""
    (df.withColumn("year", F.col("partition_year").cast("string"))
     .withColumn("month", F.lpad(F.col("partition_month").cast("string"), 2, "0"))
     .drop("partition_year", "partition_month")
     .write.mode("overwrite").partitionBy("year", "month").parquet(path))


def read_year_month_layout(spark: SparkSession, path: str) -> DataFrame:
    """Read the partitioned fact back; partition columns come from the paths."""
    df = spark.read.parquet(path)
    return (df.withColumn("partition_year", F.col("year").cast("int"))
            .withColumn("partition_month", F.col("month").cast("int"))
            .drop("year", "month"))


def export_csv(df: DataFrame, path: str) -> int:
    """Write with a header; the number of rows, counted by the write job."""
    return write_observed(lambda rows: rows.write.mode("overwrite").option("header", True).csv(path), df, "export", [])["rows"]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
