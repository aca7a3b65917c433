"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "platewise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC and adaptive plans.

    Shuffle partition counts stay with the cluster's own configuration; adaptive
    execution coalesces small ones and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # the state of streams lies on disk, not in the executors' heaps
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Where it is unset, the warehouse folder takes its place, which a cluster shares as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    return (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_work_path(spark: SparkSession, name: str) -> str:
    """A path below the work folder that no earlier run has used; it is removed when the session's JVM ends."""
    own = f"{work_root(spark)}/platewise/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    file_system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # only what exists can be booked for removal
    file_system.mkdirs(folder)
    file_system.deleteOnExit(folder)
    return f"{own}/{name}-{uuid.uuid4().hex}"
