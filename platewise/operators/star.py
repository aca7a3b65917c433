"""Star schema tables and the sentiment summary per place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.functions import dates
from platewise.functions.numbers import exact_sum, ratio, round_half_up
from platewise.functions.sentiment import NEGATIVE, POSITIVE, label_count
from platewise.schemas import WAREHOUSE_TYPES

PLACE_COLUMNS = ["place_id", "name", "address", "rating", "total_ratings", "price_level"]


def dim_time(reviews: DataFrame) -> DataFrame:
    """One row per day with a review."""
    days = reviews.select(F.to_date("review_date").alias("full_date")).distinct()
    return days.withColumns(dates.date_parts(F.col("full_date")))


def dim_restaurants(reviews: DataFrame) -> DataFrame:
    return reviews.select("place_id", F.col("restaurant_name").alias("name")).distinct()


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "place_id",
        "author_name",
        "rating",
        "text_cleaned",
        "review_length",
        "word_count",
        "review_date",
        "review_age_days",
    )


def star_schema(reviews: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_time": dim_time(reviews),
        "dim_restaurants": dim_restaurants(reviews),
        "fact_reviews": fact_reviews(reviews),
    }


def dim_users(reviews: DataFrame) -> DataFrame:
    """Reviewers with their first review and their number of reviews.

    ``user_id`` is made from the name, so that it stays the same in every load; null for a null name.
    """
    users = reviews.groupBy("author_name").agg(
        F.min("review_date").alias("first_seen"), F.count(F.lit(1)).alias("review_count")
    )
    return users.withColumn("user_id", F.md5("author_name"))


def as_warehouse_table(df: DataFrame, table: str) -> DataFrame:
    """Cast to the column types of the warehouse; a comma list replaces a list of tags."""
    casts = {c: F.col(c).cast(t) for c, t in WAREHOUSE_TYPES[table].items() if c in df.columns}
    if "types" in df.columns and df.schema["types"].dataType.typeName() == "array":
        casts["types"] = F.array_join("types", ",")
    return df.withColumns(casts) if casts else df


def prediction_rows(processed: DataFrame) -> DataFrame:
    """The prediction columns of processed reviews, in warehouse types."""
    rows = processed.select(
        "review_id",
        "place_id",
        "predicted_score",
        "sentiment_label",
        "confidence",
        "model_version",
        "predicted_at",
    )
    return as_warehouse_table(rows, "fact_predictions")


#: decimals that scores and confidences have in the predictions table
SCORE_SCALE, CONFIDENCE_SCALE = 2, 4
SUMS = ["n", "score_n", "score_sum", "confidence_n", "confidence_sum", "positive", "negative", "neutral"]


def summary_sums(predictions: DataFrame) -> DataFrame:
    """Counts and exact sums per place, of which the summary is made.

    Two such tables of different predictions add up to that of all of them, and the table
    of predictions that were replaced may be taken off.
    """
    return predictions.groupBy("place_id").agg(
        F.count("review_id").alias("n"),
        F.count("predicted_score").alias("score_n"),
        exact_sum(F.col("predicted_score"), SCORE_SCALE).alias("score_sum"),
        F.count("confidence").alias("confidence_n"),
        exact_sum(F.col("confidence"), CONFIDENCE_SCALE).alias("confidence_sum"),
        label_count(F.col("sentiment_label"), POSITIVE).alias("positive"),
        label_count(F.col("sentiment_label"), NEGATIVE).alias("negative"),
        label_count(F.col("sentiment_label"), ["neutral"]).alias("neutral"),
    )


def add_sums(stored: DataFrame, added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """The sums of ``stored`` and ``added`` without those of ``removed``; places left without predictions go."""
    all_sums = stored.unionByName(added)
    if removed is not None:
        all_sums = all_sums.unionByName(removed.withColumns({c: -F.col(c) for c in SUMS}))
    kinds = dict(stored.dtypes)
    totals = [F.sum(c).cast(kinds[c]).alias(c) for c in SUMS]
    return all_sums.groupBy("place_id").agg(*totals).filter(F.col("n") > 0)


def sentiment_summary(restaurants: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per place, also for places without predictions.

    Predictions are aggregated to place grain first, so the join moves one row per
    place instead of one per prediction and a busy place cannot skew it.
    """
    return summary_of_sums(restaurants, summary_sums(predictions))


def summary_of_sums(restaurants: DataFrame, sums: DataFrame) -> DataFrame:
    """The summary from the sums per place."""

    def mean(total: str, n: str, digits: int):
        return round_half_up(ratio(F.col(total), F.col(n)), digits)

    def zero(name: str):
        return F.coalesce(F.col(name), F.lit(0))

    joined = restaurants.select(*PLACE_COLUMNS).join(sums, "place_id", "left")
    return joined.select(
        "place_id",
        "name",
        "address",
        F.col("rating").cast("decimal(3,2)").alias("google_rating"),
        "total_ratings",
        "price_level",
        zero("n").alias("nlp_review_count"),
        mean("score_sum", "score_n", 2).alias("avg_nlp_score"),
        mean("confidence_sum", "confidence_n", 3).alias("avg_confidence"),
        zero("positive").alias("positive_count"),
        zero("negative").alias("negative_count"),
        zero("neutral").alias("neutral_count"),
        round_half_up(ratio(F.col("positive"), F.col("n")), 3).alias("positive_ratio"),
    )
