"""Raw and processed JSON, partitioned by the day of ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# fixed prefixes of the two areas
RAW_PREFIX = "raw/reviews"
PROCESSED_PREFIX = "processed/reviews"
PARTITIONS = ["year", "month", "day"]
FOLDERS = [*PARTITIONS, "location"]
MAX_ROWS_PER_FILE = 2_000_000
# JSON of reviews shrinks to about a tenth; such a file isn't split, so its rows are bounded
COMPRESSION = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def location_key(location: Column) -> Column:
    return F.lower(F.replace(location, F.lit(" "), F.lit("_")))


def write_lake(
    df: DataFrame, path: str, location: Column | str, ingested_on: Column | str | None = None, replace: bool = True
) -> None:
    """Write rows below ``year=/month=/day=/location=`` of their day of ingestion and their location.

    The rows of a day and location replace those written there before, so a rerun doesn't
    double them; other days and locations stay. With ``replace=False`` rows are added. The
    rebalance hint lets Spark split a day that holds most of the rows and merge small ones,
    so neither one task nor very many small files result. A batch of one day and location,
    which are given as plain text then, goes to one folder anyway: its tasks write what
    they hold, and nothing is shuffled. Files are compressed.
    """
    one_folder = not isinstance(location, Column) and not isinstance(ingested_on, Column)
    location = location if isinstance(location, Column) else F.lit(location)
    day = F.current_date() if ingested_on is None else F.to_date(
        ingested_on if isinstance(ingested_on, Column) else F.lit(ingested_on)
    )
    rows = df.withColumns(
        {
            "location": location_key(location),
            "year": F.date_format(day, "yyyy"),
            "month": F.date_format(day, "MM"),
            "day": F.date_format(day, "dd"),
        }
    )
    (
        (rows if one_folder else rows.hint("rebalance", *FOLDERS))
        .write.mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .options(**COMPRESSION)
        .partitionBy(*FOLDERS)
        .json(path)
    )


def read_lake(
    spark: SparkSession,
    path: str,
    schema: StructType,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    multi_line: bool = False,
    location: str | None = None,
) -> DataFrame:
    """Rows of the lake; a given year, month, day or location prunes the folders that are read.

    ``multi_line`` is for files that hold one JSON array each; such files are not split.
    """
    fields = [f for f in schema.fields if f.name not in FOLDERS]
    fields += [StructField(p, IntegerType()) for p in PARTITIONS]
    fields += [StructField("location", StringType())]
    df = spark.read.schema(StructType(fields)).option("multiLine", multi_line).json(path)
    if location is not None:
        df = df.filter(F.col("location") == location_key(F.lit(location)))
    return _pruned(df, year, month, day)


def _pruned(df: DataFrame, *values: int | None) -> DataFrame:
    for name, value in zip(PARTITIONS, values):
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def lake_files(
    spark: SparkSession, path: str, year: int | None = None, month: int | None = None, day: int | None = None
) -> DataFrame:
    """The files of a lake, or of a year, month or day of it, by name; their content is not read."""
    files = _pruned(spark.read.format("binaryFile").load(path), year, month, day)
    return files.select(F.col("path").alias("file_path"))
