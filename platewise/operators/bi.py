"""Business queries over predictions, reviews and the sentiment summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.functions import dates, sentiment
from platewise.functions.numbers import exact_mean, exact_sum, ratio, round_half_up

MIN_SUPPORT = 5


def rank_by_rating(df: DataFrame, rating: str) -> DataFrame:
    """For each rating value its competition rank, highest first and nulls on top.

    As DECIMAL(3,2) a rating has fewer than 2,000 values: the counts per value are
    aggregated in parallel, and only those few rows enter the running sum.
    """
    value = F.col(rating).cast("decimal(3,2)").alias("_value")
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    above = Window.orderBy(F.desc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_value", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias("_rank"))


def top_restaurants_by_nlp(summary: DataFrame, min_reviews: int = MIN_SUPPORT, n: int = 50) -> DataFrame:
    """The places with the best model score, with their ranks by both scores.

    All places that score higher than a listed one are listed too, so the model rank
    is computed over the limited rows. The rank by source rating needs all places and
    comes from the counts per rating value. ``summary`` is read twice: pass a
    materialised one.
    """
    eligible = summary.filter(F.col("nlp_review_count") >= min_reviews)
    top = eligible.orderBy(F.desc_nulls_first("avg_nlp_score"), "place_id").limit(n)
    rating_ranks = rank_by_rating(eligible, "google_rating")
    same = F.col("google_rating").cast("decimal(3,2)").eqNullSafe(F.col("_value"))
    listed = top.join(F.broadcast(rating_ranks), same, "left")
    return listed.select(
        "place_id",
        "name",
        "address",
        "google_rating",
        "avg_nlp_score",
        "nlp_review_count",
        "positive_ratio",
        "price_level",
        F.rank().over(Window.orderBy(F.desc_nulls_first("avg_nlp_score"))).alias("nlp_rank"),
        F.col("_rank").alias("google_rank"),
    )


def sentiment_over_time(predictions: DataFrame, reviews: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Reviews and mean score per month and label.

    Rows are summed per day and label before the calendar join, so the join sees a few
    rows per day however many reviews a day has.
    """
    per_day = (
        predictions.select("review_id", "sentiment_label", "predicted_score")
        .join(reviews.select("review_id", F.to_date("review_date").alias("full_date")), "review_id")
        .groupBy("full_date", "sentiment_label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("predicted_score").alias("scored"),
            exact_sum(F.col("predicted_score"), 2).alias("total"),
        )
    )
    months = per_day.join(dim_time.select("full_date", "year", "month"), "full_date")
    return months.groupBy("year", "month", "sentiment_label").agg(
        F.sum("n").alias("review_count"),
        round_half_up(ratio(F.sum("total"), F.sum("scored")), 2).alias("avg_score"),
    )


def score_vs_rating(summary: DataFrame, min_reviews: int = MIN_SUPPORT) -> DataFrame:
    """Gap between model score and source rating of places with enough reviews."""
    score, rating = F.col("avg_nlp_score"), F.col("google_rating")
    return summary.filter(F.col("nlp_review_count") >= min_reviews).select(
        "place_id",
        "name",
        "google_rating",
        "avg_nlp_score",
        "nlp_review_count",
        F.abs(rating.cast("decimal(18,8)") - score.cast("decimal(18,8)")).cast("double").alias("score_gap"),
        sentiment.score_alignment(score.cast("decimal(18,8)"), rating.cast("decimal(18,8)")).alias(
            "score_alignment"
        ),
    )


def review_volume_trend(
    predictions: DataFrame, reviews: DataFrame, as_of=None, days: int = 90, by_rows: bool = True
) -> DataFrame:
    """Reviews per day, mean score, and the mean volume of the last seven rows.

    ``by_rows=False`` takes the last seven calendar days instead, which differs when
    days are missing. The window runs over at most ``days + 1`` rows.
    """
    since = F.date_sub(dates.as_day(as_of), days)
    recent = reviews.filter(F.col("review_date") >= since).select("review_id", "review_date")
    daily = (
        recent.join(predictions.select("review_id", "predicted_score"), "review_id")
        .groupBy(F.to_date("review_date").alias("review_day"))
        .agg(
            F.count(F.lit(1)).alias("daily_reviews"),
            round_half_up(exact_mean(F.col("predicted_score"), 2), 2).alias("avg_daily_score"),
        )
    )
    if by_rows:
        last_seven = Window.orderBy("review_day").rowsBetween(-6, 0)
    else:
        last_seven = Window.orderBy(F.unix_date("review_day")).rangeBetween(-6, 0)
    return daily.withColumn("rolling_7d_avg", F.avg("daily_reviews").over(last_seven))


def price_vs_sentiment(summary: DataFrame) -> DataFrame:
    """Means of the place means, per price level."""
    return (
        summary.filter(F.col("price_level").isNotNull())
        .groupBy("price_level")
        .agg(
            F.count_distinct("place_id").alias("restaurant_count"),
            round_half_up(exact_mean(F.col("avg_nlp_score"), 2), 2).alias("avg_sentiment_score"),
            round_half_up(exact_mean(F.col("positive_ratio"), 3), 3).alias("avg_positive_ratio"),
            round_half_up(exact_mean(F.col("google_rating"), 2), 2).alias("avg_google_rating"),
        )
    )


def confidence_tiers(predictions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Volume, means and mean absolute error per confidence tier."""
    joined = predictions.select("review_id", "predicted_score", "confidence").join(
        reviews.select("review_id", "rating"), "review_id"
    )
    predicted = F.col("predicted_score").cast("decimal(8,2)")
    actual = F.col("rating").cast("decimal(8,2)")
    return joined.groupBy(sentiment.confidence_tier(F.col("confidence")).alias("confidence_tier")).agg(
        F.count(F.lit(1)).alias("prediction_count"),
        round_half_up(exact_mean(predicted, 2), 2).alias("avg_predicted"),
        round_half_up(exact_mean(actual, 2), 2).alias("avg_actual"),
        round_half_up(exact_mean(F.abs(predicted - actual), 2), 2).alias("avg_error"),
    )


def _per_place_analytics(
    predictions: DataFrame, reviews: DataFrame, restaurants: DataFrame, counts: dict[str, Column], score: str
) -> DataFrame:
    """Join on review id, aggregate to place grain, then add the place's name."""
    joined = predictions.select("review_id", "place_id", "predicted_score", "sentiment_label").join(
        reviews.select("review_id", "rating"), "review_id"
    )
    per_place = joined.groupBy("place_id").agg(
        F.count(F.lit(1)).alias("prediction_count"),
        round_half_up(exact_mean(F.col("predicted_score"), 2), 2).alias(score),
        round_half_up(exact_mean(F.col("rating"), 2), 2).alias("avg_actual_rating"),
        *[c.alias(name) for name, c in counts.items()],
    )
    return per_place.join(restaurants.select("place_id", "name"), "place_id")


def sentiment_analytics_warehouse(
    predictions: DataFrame, reviews: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """All places; only the plain labels are counted, not the ``very_`` ones."""
    label = F.col("sentiment_label")
    counts = {
        "positive_count": F.count_if(label == "positive"),
        "negative_count": F.count_if(label == "negative"),
        "neutral_count": F.count_if(label == "neutral"),
    }
    return _per_place_analytics(
        predictions, reviews, restaurants, counts, "avg_predicted_score"
    ).withColumnRenamed("name", "restaurant_name")


def sentiment_analytics_api(
    predictions: DataFrame, reviews: DataFrame, restaurants: DataFrame, min_predictions: int = 3, n: int = 50
) -> DataFrame:
    """The best places with enough predictions; ``very_`` labels are counted too."""
    label = F.col("sentiment_label")
    counts = {
        "positive_count": sentiment.label_count(label, sentiment.POSITIVE),
        "negative_count": sentiment.label_count(label, sentiment.NEGATIVE),
    }
    places = _per_place_analytics(predictions, reviews, restaurants, counts, "avg_nlp_score")
    return (
        places.filter(F.col("prediction_count") >= min_predictions)
        .orderBy(F.desc_nulls_first("avg_nlp_score"), "place_id")
        .limit(n)
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionAll(other)
    return out


def volume_anomalies(days: DataFrame, day: str = "day", volume: str = "volume", window: int = 7, z: float = 2.0):
    """Days whose volume lies far from the mean of the days before.

    ``days`` has one row per day and is small; the flag needs at least two earlier days.
    """
    before = Window.orderBy(day).rowsBetween(-window, -1)
    value = F.col(volume)
    return (
        days.withColumns(
            {
                "trailing_mean": F.avg(value).over(before),
                "trailing_std": F.stddev_samp(value).over(before),
            }
        )
        .withColumn(
            "z_score", (value - F.col("trailing_mean")) / F.nullif(F.col("trailing_std"), F.lit(0.0))
        )
        .withColumn("is_anomaly", F.coalesce(F.abs("z_score") >= z, F.lit(False)))
    )


def geo_grid_quality(restaurants: DataFrame, summary: DataFrame, cell: float = 0.1) -> DataFrame:
    """Places, predictions and mean score per cell of a latitude/longitude grid."""
    cells = restaurants.select(
        "place_id",
        F.floor(F.col("latitude").cast("double") / cell).alias("lat_cell"),
        F.floor(F.col("longitude").cast("double") / cell).alias("lng_cell"),
    )
    return (
        cells.join(summary.select("place_id", "avg_nlp_score", "nlp_review_count"), "place_id")
        .groupBy("lat_cell", "lng_cell")
        .agg(
            F.count(F.lit(1)).alias("place_count"),
            F.sum("nlp_review_count").alias("prediction_count"),
            round_half_up(exact_mean(F.col("avg_nlp_score"), 2), 2).alias("avg_score"),
        )
    )


def credibility_score(scored: DataFrame, users: DataFrame) -> DataFrame:
    """Mean score per place, weighted by ln(1 + number of reviews of the reviewer).

    Reviews are first summed per reviewer and place, so the join with ``users`` carries
    one row per pair and not one per review.
    """
    pairs = scored.groupBy("author_name", "place_id").agg(
        F.count("predicted_score").alias("n"),
        exact_sum(F.col("predicted_score"), 3).cast("double").alias("total"),
    )
    weighted = pairs.join(
        users.select("author_name", F.log1p("review_count").alias("weight")), "author_name"
    )
    return weighted.groupBy("place_id").agg(
        round_half_up(
            F.sum(F.col("total") * F.col("weight")) / F.nullif(F.sum(F.col("n") * F.col("weight")), F.lit(0.0)), 3
        ).alias("credibility_score"),
        F.sum("n").alias("review_count"),
    )
