"""SparkSession construction and the shared checkpoint folder."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def sibling_session(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    """A session of the same application with the settings of this one and some of its own."""
    other = spark.newSession()
    for key, value in {**spark.conf.getAll, **(settings or {})}.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only a local-mode
    session (tests, the bench) gets its own folder when none is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def shared_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerlens-{name}-{uuid.uuid4().hex[:12]}"


def cleanup_work_dirs(spark: SparkSession) -> int:
    """Delete the ledgerlens-* folders this application wrote under the checkpoint
    folder (call once the DataFrames reading them are no longer needed)."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        return 0
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    removed = 0
    if fs.exists(path):
        for st in fs.listStatus(path):
            if st.getPath().getName().startswith("ledgerlens-"):
                fs.delete(st.getPath(), True)
                removed += 1
    return removed
