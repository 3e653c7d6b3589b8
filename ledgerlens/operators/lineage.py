"""Cutting lineage with a table written to the shared checkpoint folder."""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_work_dir, sibling_session

_written: list[str] = []


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once as parquet under spark.checkpoint.dir and read it back.

    The plan executes exactly once, the result survives executor loss, and
    later jobs (several aggregations over the same frame) see identical rows.
    """
    if is_written(df):
        return df
    spark = df.sparkSession
    path = shared_work_dir(spark, name)
    _written.append(path)
    df.write.mode("overwrite").parquet(path, compression=compression)
    out = spark.read.parquet(path)
    out._ledgerlens_written = True  # plain scan of a written table: cheap to re-read
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote; nothing may read it after that."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def is_written(df: DataFrame) -> bool:
    return bool(getattr(df, "_ledgerlens_written", False))


#: Shuffle files are deleted at the end of the query they belong to, not when their frame is collected as garbage.
SHUFFLES_REMOVED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def read_by(session: SparkSession, df: DataFrame) -> DataFrame:
    """A written table read anew by another session of the application."""
    folders = {path.rsplit("/", 1)[0] for path in df.inputFiles()}
    out = session.read.schema(df.schema).parquet(*sorted(folders)) if folders else session.createDataFrame([], df.schema)
    out._ledgerlens_written = True
    return out


def in_small_splits(df: DataFrame, most: str) -> DataFrame:
    """A written table read anew, in partitions of at most ``most`` of its files, by a session of its own."""
    if not df.inputFiles():
        return df
    return read_by(sibling_session(df.sparkSession, {"spark.sql.files.maxPartitionBytes": most}), df)


@contextmanager
def written_tables_removed(spark: SparkSession):
    """Delete at its end the tables that ``materialize`` wrote inside; nothing may read them after that."""
    start = len(_written)
    try:
        yield
    finally:
        for path in _written[start:]:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        del _written[start:]
