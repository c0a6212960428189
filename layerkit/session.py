"""Spark session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

# UTC keeps date arithmetic stable; static overwrite makes a full refresh drop
# partitions that are missing from the new data; AQE splits skewed join keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Many small shuffle partitions at first; adaptive execution merges them.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000"}

CONCURRENT_JOBS = 4

# Names under which this application has put bucketed scratch tables into the catalogue.
catalogued: list[str] = []


def build_session(app_name: str, log_level: str = "WARN", **conf: str) -> SparkSession:
    """Session with the settings above; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        for key, value in CLUSTER_SETTINGS.items():
            if key not in conf:
                spark.conf.set(key, value)
    spark.sparkContext.setLogLevel(log_level)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only for local masters."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            # Executors of a local-cluster are processes of their own.
            if context.master.startswith("local-cluster") or not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="layerkit-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's own folder below the checkpoint folder, and its names in the catalogue.

    Call it when no result that reads intermediates is needed any more.
    """
    while catalogued:
        spark.sql(f"DROP TABLE IF EXISTS {catalogued.pop()}")
    folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def relieve(spark: SparkSession, always: bool = False) -> None:
    """Have the driver collect its garbage, if that fills a third of its memory or ``always``.

    Spark drops the shuffle files and broadcasts of finished jobs only when the
    driver has collected what named them. A driver that does little but plan does
    so seldom, while files fill the executors' disks and its own memory grows.
    """
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if always or runtime.totalMemory() - runtime.freeMemory() > runtime.maxMemory() // 3:
        spark.sparkContext._jvm.java.lang.System.gc()


def concurrently(work: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Results of independent jobs, which share the cluster while they run."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        return list(pool.map(work, items))
