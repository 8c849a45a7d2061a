"""Session helpers: configuration for local runs and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "starflow", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured the way the cluster jobs expect (AQE on, UTC)."""
    parts = shuffle_partitions or (int(cpus) * 2 if str(cpus).isdigit() else 16)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide work folder named by ``spark.checkpoint.dir``.

    Read from the session. Only on a local master (tests, the bench), where
    every task shares the driver's disk, a private folder stands in for a
    missing setting; on a cluster that would be another disk on each executor.
    """
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not path and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="starflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder (never machine-local)."""
    base = shared_dir(spark)
    return f"{base}/starflow/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def exchanges_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside it, a query's exchanges leave the disk when the query ends, not when the driver collects its garbage.

    For queries that run one after the other and are each run once; the frame of one that has ended can't be run again cheaply.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)
