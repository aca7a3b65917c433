"""Parquet tables with versions: a refresh writes a new folder and readers take the latest."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

VERSION = "version="


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of finished versions, oldest first; an unfinished write has no marker."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    folders = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(VERSION)]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    done = [f.toString() for f in folders if fs.exists(marker(f, "_SUCCESS"))]
    return sorted(done)


def write_version(df: DataFrame, path: str, name: str | None = None, keep: int = 2) -> DataFrame:
    """Write ``df`` as the next version and return it read back.

    ``df`` may read an earlier version of the same table: that one stays untouched. A
    fixed ``name`` makes a repeated write of the same batch replace itself. The last
    ``keep`` finished versions stay, for readers that began before; older ones are removed.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/{VERSION}{name or f'{time.time_ns():020d}'}"
    df.write.mode("overwrite").parquet(folder)
    for old in versions(spark, path)[:-keep]:
        fs, gone = _file_system(spark, old)
        fs.delete(gone, True)
    return spark.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, pattern: str, which: Callable[[str], bool]) -> None:
    """Delete the folders that match ``pattern`` and whose name passes ``which``."""
    fs, glob = _file_system(spark, pattern)
    for status in fs.globStatus(glob) or []:
        if which(status.getPath().getName()):
            fs.delete(status.getPath(), True)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no finished version below {path}")
    return spark.read.parquet(found[-1])
