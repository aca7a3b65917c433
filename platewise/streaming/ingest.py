"""Reviews as a stream of files: the batch operators on micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from platewise.operators.cleaning import clean_rows, engineer_features
from platewise.sources import snapshots


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, file_format: str = "parquet", pattern: str | None = None
) -> DataFrame:
    """New files of a folder as a stream; ``pattern`` limits the file names."""
    reader = spark.readStream.schema(schema).format(file_format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


BATCH = "batch"


def latest_copies(rows: DataFrame, key: str, newest: list[str]) -> DataFrame:
    """The newest row of each key over all batches, kept in Spark's state store.

    The order is that of the columns ``newest`` and then of all others, so it doesn't
    depend on how rows fall into batches: an older copy that arrives late replaces nothing,
    and no row is too late. A batch gives the keys that it touches. Copies are reduced per
    task before the shuffle, so a key with very many copies is no hot one. The state is as
    large as the table: ``build_session`` keeps it in RocksDB, on disk and in checkpoints.
    """
    rest = [c for c in rows.columns if c not in (key, *newest)]
    best = rows.groupBy(key).agg(F.max(F.struct(*newest, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def append_batches(updates: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write what each batch updates below ``table``, in a folder with the batch's number.

    A repeat after a failure replaces its own folder. Nothing else is read, listed or
    rewritten, however many batches there were.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batches/{BATCH}={batch_id}")

    return (
        updates.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batches(spark: SparkSession, table: str) -> DataFrame:
    folder = f"{table.rstrip('/')}/batches"
    rows = spark.read.option("basePath", folder).parquet(f"{folder}/{BATCH}=*")
    return rows.withColumn(BATCH, F.col(BATCH).cast("bigint"))


def read_stream_table(spark: SparkSession, table: str, key: str) -> DataFrame:
    """The current row of each key of a table that ``append_batches`` writes: that of its last batch.

    Batches that the last compaction covers are not read.
    """
    rows = _batches(spark, table)
    whole = snapshots.versions(spark, f"{table.rstrip('/')}/whole")
    if whole:
        covered = int(whole[-1].rsplit(snapshots.VERSION, 1)[1])
        rows = rows.filter(F.col(BATCH) > covered)
        rows = rows.unionByName(spark.read.parquet(whole[-1]).withColumn(BATCH, F.lit(covered).cast("bigint")))
    names = [c for c in rows.columns if c not in (key, BATCH)]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*names), BATCH).alias("_row"))
    return best.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in rows.columns if c != BATCH])


def compact(spark: SparkSession, table: str, key: str) -> None:
    """Rewrite the table's current rows as one version; to be run now and then, beside the stream.

    The version is named by the last batch in it. Folders of batches that the version
    before covers are removed: readers that began before this one don't need them.
    """
    root = f"{table.rstrip('/')}/whole"
    before = snapshots.versions(spark, root)
    last = _batches(spark, table).agg(F.max(BATCH)).first()[0]
    current = read_stream_table(spark, table, key)
    snapshots.write_version(current, root, f"{last:020d}")
    if before:
        covered = int(before[-1].rsplit(snapshots.VERSION, 1)[1])
        snapshots.remove(spark, f"{table.rstrip('/')}/batches/{BATCH}=*", lambda name: int(name.split("=")[1]) <= covered)


def ingest_reviews(
    reviews: DataFrame, table: str, checkpoint: str, event_time: str = "event_time", as_of=None
) -> StreamingQuery:
    """Clean, add features, and keep the latest copy of each review.

    Reviews carry any age, so there is no watermark: a review of an earlier year counts
    as any other, and an edited copy replaces the one it edits.
    """
    rows = engineer_features(clean_rows(reviews), as_of)
    return append_batches(latest_copies(rows, "review_id", [event_time]), table, checkpoint)


def windowed_counts(
    events: DataFrame, group: str, event_time: str = "event_time", width: str = "1 day", delay: str | None = None
) -> DataFrame:
    """Events per tumbling window and group, of any age.

    Every arriving row is an event; for counts of reviews, each once, group the table
    that ``ingest_reviews`` keeps. The state is a number per window and group. Only where
    these grow without end, ``delay`` closes windows by a watermark, and later rows are
    then not counted.
    """
    timed = events if delay is None else events.withWatermark(event_time, delay)
    return (
        timed.groupBy(F.window(event_time, width).alias("w"), group)
        .agg(F.count(F.lit(1)).alias("review_count"))
        .select(
            F.concat_ws("|", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss"), group).alias("window_key"),
            F.col("w.start").alias("window_start"),
            group,
            "review_count",
        )
    )
