"""Tables laid out for look-ups of few rows: sorted by one key, with Bloom filters for others."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

#: bytes of a row group; a look-up reads the groups that may hold its key
GROUP_BYTES = 16 << 20
#: distinct values a Bloom filter is made for, about the rows of a group of short rows
GROUP_VALUES = 100_000


def write_lookup(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str],
    bloom: Iterable[str] = (),
    group_bytes: int = GROUP_BYTES,
    group_values: int = GROUP_VALUES,
) -> None:
    """Write ``df`` sorted by ``sort_by`` across all files, with Bloom filters of ``bloom``.

    A filter on the first sort key reads the row groups whose range holds the value, one on a
    Bloom key those whose filter may hold it; both are Spark's pushed filters, so readers use
    ``spark.read.parquet`` and ``filter``. Ranges are cut by all of ``sort_by``: end it with
    a key that tells rows apart, so that the rows of one hot value are spread over tasks.
    """
    options = {"parquet.block.size": str(group_bytes)}
    for name in bloom:
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(group_values)
    ordered = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    ordered.write.mode("overwrite").options(**options).parquet(path)
