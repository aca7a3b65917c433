"""Parquet tables bucketed by key: merges and anti joins by that key leave the stored side where it is.

A table is a folder with versions, of which the newest finished one counts. Every version
is written through Spark's own bucketed tables and registered in the session's catalog, so
a join by the key reads matching buckets and shuffles only the other side.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from platewise.operators.merge import merge_by_key
from platewise.sources import snapshots


@dataclass(frozen=True)
class BucketedTable:
    """Where a table lies and how it is cut. ``buckets`` must stay the same for a table.

    A bucket is one task of a merge, so there should be as many as the cluster's shuffle
    partitions for a table of the usual batches' size, and more for a larger one. Buckets
    go by the key's hash; a key that occurs once, as merges leave it, makes none large.
    """

    path: str
    key: str
    buckets: int = 200


def _name(table: BucketedTable, folder: str) -> str:
    """The version's name in the catalog, however its folder is written."""
    version = folder.rstrip("/").rsplit("/", 1)[1]
    return f"bucketed_{hashlib.md5(f'{table.path.rstrip("/")}/{version}'.encode()).hexdigest()}"


def _registered(spark: SparkSession, table: BucketedTable, folder: str) -> DataFrame:
    name = _name(table, folder)
    if not spark.catalog.tableExists(name):
        fields = spark.read.parquet(folder).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{table.key}`) "
            f"SORTED BY (`{table.key}`) INTO {table.buckets} BUCKETS LOCATION '{folder}'"
        )
    return spark.table(name)


def read(spark: SparkSession, table: BucketedTable) -> DataFrame:
    """The newest version; also one that another session wrote."""
    found = snapshots.versions(spark, table.path)
    if not found:
        raise FileNotFoundError(f"no finished version below {table.path}")
    return _registered(spark, table, found[-1])


def write(df: DataFrame, table: BucketedTable, dealt: bool = False, keep: int = 2) -> DataFrame:
    """Write ``df`` as the next version and return it; the last ``keep`` versions stay.

    Rows are dealt to buckets first, so that each is one file. ``dealt`` says that every
    task holds rows of one bucket already, as after a join with the table by its key.
    """
    spark = df.sparkSession
    folder = f"{table.path.rstrip('/')}/{snapshots.VERSION}{time.time_ns():020d}"
    rows = df if dealt else df.repartition(table.buckets, table.key)
    writer = rows.write.format("parquet").option("path", folder)
    writer.bucketBy(table.buckets, table.key).sortBy(table.key).saveAsTable(_name(table, folder))
    for old in snapshots.versions(spark, table.path)[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {_name(table, old)}")
        snapshots.remove(spark, old, lambda name: True)
    return spark.table(_name(table, folder))


def merge_into(table: BucketedTable, updates: DataFrame, **how) -> DataFrame:
    """Merge a batch into the stored rows (``how`` as of ``merge_by_key``) and write the next version.

    The batch is shuffled into the table's buckets; the stored rows are read bucket by
    bucket and written by the task that merged them. The first batch makes the table.
    """
    spark = updates.sparkSession
    if not snapshots.versions(spark, table.path):
        empty = spark.createDataFrame([], updates.schema)
        return write(merge_by_key(empty, updates, table.key, **how), table)
    return write(merged(table, updates, **how), table, dealt=True)


def merged(table: BucketedTable, updates: DataFrame, **how) -> DataFrame:
    """What ``merge_into`` writes."""
    return merge_by_key(read(updates.sparkSession, table), updates, table.key, **how)
