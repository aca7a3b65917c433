"""Tables, the work folder and Arrow batches, shared by the operators of this package."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from platewise.session import new_work_path

#: bytes of text worked on at once in a task; one longer text is worked on alone
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared work folder and read back: lineage ends here."""
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def saved_and_freed(df: DataFrame, name: str) -> DataFrame:
    """``saved``, for steps of a long job: the shuffle files of finished steps go at once.

    Spark removes them when the driver's garbage is collected, which a driver with little
    to do may not see for the rest of the job; disk would then hold all steps together.
    """
    out = saved(df, name)
    df.sparkSession._jvm.System.gc()
    return out


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, wherever filters and projections are moved.

    A name bound by a lambda can't be replaced by what it stands for, as a column of a
    projection is when a filter above it is pushed below.
    """
    return F.transform(F.array(value), use)[0]


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def fold_of(doc_id: int | None, parts: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def labelled_sample(labels: DataFrame, label: str, parts: int, held: int, rows: int) -> DataFrame:
    """``doc_id`` and ``label`` of at most ``rows`` labelled ids of each class, none of the held-out fold.

    The ids with the smallest hashes are taken, so a sample does not depend on partitions
    and has a fixed size whatever the size of the corpus. Ids labelled twice take the
    larger label; null ids and labels are left out.
    """
    known = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", parts) != held))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return (
        known.filter("label = 1")
        .orderBy(*order)
        .limit(rows)
        .unionByName(known.filter("label = 0").orderBy(*order).limit(rows))
    )


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``limit`` bytes; null texts become empty."""
    at = batch.schema.get_field_index(column)
    text = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
    batch = batch.set_column(at, column, text)
    ends = np.cumsum(np.asarray(pc.binary_length(text.cast(pa.large_binary())), dtype=np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large_string array without nulls, and where each row starts in them."""
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


#: Spark's name of a type and Arrow's
TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
}


def record(schema: str, values: dict[str, object]) -> pa.RecordBatch:
    """A batch of the columns that ``schema`` (``name type, ...``) lists."""
    fields = [pa.field(*_field(x)) for x in schema.split(", ")]
    arrays = [_as(values[f.name], f.type) for f in fields]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


def _field(text: str) -> tuple[str, pa.DataType]:
    name, kind = text.split(" ")
    return name, TYPES[kind]


def _as(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def map_text(
    df: DataFrame,
    columns: list[str],
    work: Callable[[pa.RecordBatch], dict[str, object]],
    schema: str,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Run ``work`` over slices of the ``text`` column and the named columns; it returns output columns by name.

    ``work`` gets no null text. Rows stay where they are: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=limit):
                yield record(schema, work(part))

    return df.select(*columns, "text").mapInArrow(run, schema)
