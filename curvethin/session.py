"""Spark session and checkpoint-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "curvethin", **conf: str) -> SparkSession:
    """Session for tests, bench and local runs (UI off, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CURVETHIN_DRIVER_MEMORY", "12g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints.

    Uses the directory the session already has (``spark.checkpoint.dir`` or
    ``SparkContext.setCheckpointDir``).  Only a local-mode session without one
    gets a fresh temporary folder; on a cluster an unset folder is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder (HDFS/S3/...) before "
            "thinning series longer than max_series_rows")
    path = tempfile.mkdtemp(prefix="curvethin-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside are deleted as each ends; without, they stay until the driver happens to collect garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


_STORED: dict[str, list[str]] = {}  # folders written by ``store``, by application


def store(df: DataFrame, *partition_by: str) -> DataFrame:
    """Cuts the lineage: written as compressed Parquet under the checkpoint folder and read back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    with swept(spark):
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession) -> int:
    """How many tables ``store`` has written in this application and not yet deleted."""
    return len(_STORED.get(spark.sparkContext.applicationId, []))


def clear_stored(spark: SparkSession, keep: int = 0) -> None:
    """Deletes what ``store`` wrote in this application, but for the first ``keep`` tables; frames that
    read them are no longer usable."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _STORED.get(spark.sparkContext.applicationId, [])
    while len(paths) > keep:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(conf).delete(p, True)
