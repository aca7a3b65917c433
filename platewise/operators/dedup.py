"""One row per key, chosen by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn("_position", F.row_number().over(ordered))
    return ranked.filter(F.col("_position") <= n).drop("_position")


def top_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark turns the rank filter into a group limit that runs before the shuffle, so a
    key holding a large part of all rows sends at most ``n`` rows per task. It does so
    for small ``n`` only; a larger one first takes ``n`` rows of each of many parts of
    a key, which hold the first ``n`` of the whole key.
    """
    conf = df.sparkSession.conf
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        # by input partition: equal rows of a hot key are split as well
        parts = int(conf.get("spark.sql.shuffle.partitions"))
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(parts)))
        df = _first(salted, [*keys, "_salt"], order_by, n).drop("_salt")
    return _first(df, keys, order_by, n)


def dedup_reviews(df: DataFrame, order_by: Sequence[Column] | None = None) -> DataFrame:
    """One row per ``review_id``: the latest ingested, then by the remaining columns."""
    if order_by is None:
        rest = [c for c in df.columns if c not in ("review_id", "ingested_at")]
        order_by = [F.col("ingested_at").desc_nulls_last(), *map(F.col, rest)]
    return top_per_key(df, ["review_id"], order_by)
