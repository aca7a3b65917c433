"""Look-ups read few row groups of tables laid out for them."""

import pytest
from pyspark.sql import functions as F

from platewise.sources import lookup

ROWS = 40_000


def _rows_read(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """A hot place with a third of all rows; the plain copy has the same order without filters."""
    folder = str(tmp_path_factory.mktemp("lookup"))
    number = F.col("id")
    rows = spark.range(ROWS, numPartitions=8).select(
        F.md5(number.cast("string")).alias("review_id"),
        F.when(number % 3 == 0, "P-hot").otherwise(F.concat(F.lit("P"), number % 997)).alias("place_id"),
        F.repeat(F.md5((number + 1).cast("string")), 3).alias("text"),
    )
    keys = ["place_id", "review_id"]
    # partitions this small would be joined into one file
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    lookup.write_lookup(rows, folder + "/bloom", keys, ["review_id"], group_bytes=1 << 16, group_values=2000)
    lookup.write_lookup(rows, folder + "/plain", keys, group_bytes=1 << 16)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return rows, spark.read.parquet(folder + "/bloom"), spark.read.parquet(folder + "/plain")


def test_rows_are_whole_and_a_hot_value_is_spread(layout):
    rows, table, _ = layout
    assert sorted(table.collect()) == sorted(rows.collect())
    hot = table.filter("place_id = 'P-hot'").select(F.input_file_name()).distinct()
    assert hot.count() > 1


def test_a_look_up_by_id_reads_the_groups_its_filter_names(spark, layout):
    rows, table, plain = layout
    for number in (0, 17, 39_999):
        wanted = F.col("review_id") == F.md5(F.lit(str(number)))
        value = spark.range(1).select(F.md5(F.lit(str(number)))).first()[0]
        found = table.filter(F.col("review_id") == value)
        assert found.collect() == rows.filter(wanted).collect() and found.count() == 1
        assert _rows_read(found) < ROWS / 20
        assert _rows_read(found) < _rows_read(plain.filter(F.col("review_id") == value)) / 3
    absent = table.filter("review_id = 'no such id'")
    assert absent.count() == 0 and _rows_read(absent) < ROWS / 20


def test_a_look_up_by_the_sort_key_reads_its_range(layout):
    rows, table, _ = layout
    found = table.filter("place_id = 'P500'")
    assert sorted(found.collect()) == sorted(rows.filter("place_id = 'P500'").collect())
    assert _rows_read(found) < ROWS / 20
