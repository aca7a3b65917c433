"""Cleaning and features of raw reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from platewise.functions import dates, sentiment, text
from platewise.operators.dedup import dedup_reviews

MIN_TEXT_LENGTH = 5


def clean_rows(df: DataFrame, mode: str = "pipeline") -> DataFrame:
    """The row-wise part of cleaning, which also suits a stream.

    Both modes add ``text_cleaned`` and ``review_date`` and drop short texts; only
    ``pipeline`` clamps ratings.
    """
    out = (
        df.withColumn("text_cleaned", text.strip_markup(F.col("text"), mode))
        .filter(F.length("text_cleaned") > MIN_TEXT_LENGTH)
        .withColumn("review_date", dates.epoch_to_timestamp(F.col("time_epoch")))
    )
    if mode == "pipeline":
        out = out.withColumn("rating", sentiment.clamp_rating(F.col("rating")))
    return out


def clean_reviews(
    df: DataFrame,
    mode: str = "pipeline",
    order_by: Sequence[Column] | None = None,
    observe: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Dedupe, then clean. ``observe`` counts rows before and after in the same action."""
    if observe:
        df = df.observe(observe[0], F.count(F.lit(1)).alias("rows"))
    out = clean_rows(dedup_reviews(df, order_by), mode)
    if observe:
        out = out.observe(observe[1], F.count(F.lit(1)).alias("rows"))
    return out


def engineer_features(df: DataFrame, as_of=None, mode: str = "pipeline") -> DataFrame:
    """Length, words and calendar features of cleaned reviews."""
    out = df.withColumns(
        {
            "review_length": F.length("text_cleaned"),
            "word_count": text.word_count(F.col("text_cleaned")),
            "day_of_week": F.dayofweek("review_date"),
        }
    )
    if mode == "job":
        return out.withColumns(
            {
                "review_year": F.year("review_date"),
                "review_month": F.month("review_date"),
                "rating_category": sentiment.rating_category(F.col("rating")),
            }
        )
    return out.withColumns(
        {
            "has_text": F.coalesce(F.col("review_length") > 0, F.lit(False)),
            "review_age_days": dates.age_days(F.col("review_date"), as_of),
        }
    )


def clean_counts(raw: DataFrame, mode: str = "pipeline") -> DataFrame:
    """Rows before and after cleaning, as one row, counted while one action cleans them."""
    before, after = Observation(), Observation()
    clean_reviews(raw, mode, observe=(before, after)).write.format("noop").mode("overwrite").save()
    counts = before.get["rows"], after.get["rows"]
    return raw.sparkSession.createDataFrame(
        [(*counts, counts[0] - counts[1])], "input_rows bigint, output_rows bigint, removed_rows bigint"
    )


def batch_text_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """How many texts of a batch have any content after normalisation."""
    normalized = text.normalize_text(F.col(text_col))
    return df.select(normalized.alias("t")).agg(
        F.count(F.lit(1)).alias("input_texts"), F.count_if(F.col("t") != "").alias("valid_texts")
    )
