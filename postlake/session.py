"""Spark session and shared-folder helpers.

Every job in the package takes a ``SparkSession`` from the caller; this module
only supplies a sensible local builder for tests and the bench, plus the one
place that decides where intermediate tables and checkpoints live.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "postlake",
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session configured the way the cluster jobs expect.

    ANSI stays on (Spark 4 default); every parse in the package uses the
    ``try_*`` family so malformed values become null instead of failing.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.pythonUDF.arrow.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local session (tests, bench)
    without the setting gets a fresh private folder under the system temp
    directory; a cluster session without it is an error, because a
    machine-local folder is not visible to other executors.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder (HDFS/object store)"
            )
        path = tempfile.mkdtemp(prefix="postlake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared folder for an intermediate table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that ``scratch_path`` named."""
    found, files = _hadoop(spark, path)
    files.delete(found, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    found, files = _hadoop(spark, path)
    return files.exists(found) and files.getFileStatus(found).isDirectory()
