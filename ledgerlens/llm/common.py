"""Small helpers shared by the operators of this subpackage."""
from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import materialize
from ..session import ensure_checkpoint_dir, shared_work_dir

__all__ = ["drop_written", "explode_copies", "forget_shuffles", "materialize", "partition_id", "parts", "read", "record_batch",
           "shared_work_dir", "shuffle_parts", "slices"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table of ``sf_dir`` through Spark's reader (any file system Spark knows)."""
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partition_id() -> int:
    """The running task's partition (0 outside a task, as in unit tests)."""
    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def drop_written(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and no later plan reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for frame in frames:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = hadoop(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Its cleaner follows the driver's garbage collector, which may not run for a long time.
    """
    spark.sparkContext._jvm.System.gc()


def explode_copies(df: DataFrame, copies: str, nth: str) -> DataFrame:
    """One row for each of ``copies`` repetitions, numbered from 1 in ``nth``."""
    return df.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies)


def parts(batches, rows: int = 1000):
    """The batches in slices of so many rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def slices(texts: list[str], most_texts: int, most_chars: int):
    """(start, end) of consecutive texts, at most so many together and about so many characters."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= most_texts or size + len(text) > most_chars):
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
