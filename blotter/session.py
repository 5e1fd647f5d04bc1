"""Session helpers.

Library code never mutates an existing session's SQL settings; it only reads
them. ``get_spark`` is for scripts and tests that own their session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "blotter",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session tuned for the marts: AQE on, UI off, Arrow on."""
    master = master or os.environ.get("BLOTTER_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; without it this raises, because a folder of the driver's machine is
    not the executors'. Only a session in one process (local tests) gets a
    private folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to storage that every executor of {master} shares")
    local = tempfile.mkdtemp(prefix="blotter-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for staged tables and stream state."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/blotter/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (any Hadoop-compatible store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is under it, on whichever file system it is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target`` (on the same file system)."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise RuntimeError(f"could not move {source} to {target}")


def put_path(spark: SparkSession, source: str, target: str) -> None:
    """:func:`replace_path` that first makes the folder above the target."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path.getParent())
    replace_path(spark, source, target)
