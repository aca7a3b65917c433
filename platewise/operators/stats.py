"""Statistics per place, derived from one table of exact sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.functions.numbers import ratio, round_half_up

PLACE = ["place_id", "restaurant_name"]
#: ratings are summed as whole numbers of this fraction of a star
STEPS = 10_000


def place_sums(df: DataFrame) -> DataFrame:
    """Whole-number sums per place: equal for any partitioning, and two such tables may be added.

    Ratings count to four decimals. ``stars`` holds how many ratings are exactly 1 and 5
    and how many are at most 2 and at least 4. Sums of measures a frame lacks are absent.
    """
    rating = F.col("rating")
    steps = F.round(rating * STEPS).cast("bigint")
    tests = {"one": rating == 1, "low": rating <= 2, "high": rating >= 4, "five": rating == 5}
    sums = {
        "reviews": F.count(F.lit(1)),
        "rated": F.count("rating"),
        "steps": F.sum(steps),
        "squares": F.sum(steps * steps),
        "first_day": F.min("review_date"),
        "last_day": F.max("review_date"),
        "stars": F.struct(*[F.count_if(t).alias(k) for k, t in tests.items()]),
    }
    for name in ("review_length", "word_count"):
        if name in df.columns:
            sums[name] = F.struct(F.sum(F.col(name).cast("bigint")).alias("total"), F.count(name).alias("n"))
    return df.groupBy(*PLACE).agg(*[c.alias(k) for k, c in sums.items()])


def _mean(measure: str) -> Column:
    return ratio(F.col(measure)["total"], F.col(measure)["n"])


def _mean_rating() -> Column:
    return ratio(F.col("steps"), F.col("rated") * STEPS)


def _deviation() -> Column:
    """Sample deviation of the ratings; the difference is taken on decimals, so nothing cancels. Null below two ratings."""
    n, total = F.col("rated").cast("decimal(18,0)"), F.col("steps").cast("decimal(19,0)")
    spread = (n * F.col("squares").cast("decimal(19,0)") - total * total).cast("double")
    pairs = F.col("rated").cast("double") * (F.col("rated") - 1)
    return F.sqrt(spread / F.nullif(pairs, F.lit(0.0))) / STEPS


def restaurant_stats(df: DataFrame) -> DataFrame:
    """Unrounded statistics; "positive" means a rating of exactly 5."""
    stars = F.col("stars")
    return place_sums(df).select(
        *PLACE,
        F.col("reviews").alias("review_count"),
        stars["five"].alias("five_star_count"),
        stars["one"].alias("one_star_count"),
        ratio(stars["five"], F.col("reviews")).alias("positive_ratio"),
        _mean_rating().alias("avg_rating"),
        F.coalesce(_deviation(), F.lit(0.0)).alias("rating_stddev"),
        _mean("review_length").alias("avg_review_length"),
        _mean("word_count").alias("avg_word_count"),
        F.col("first_day").alias("earliest_review_date"),
        F.col("last_day").alias("latest_review_date"),
    )


def restaurant_stats_job(df: DataFrame) -> DataFrame:
    """Rounded statistics of the batch job; "positive" means a rating of 4 and more."""
    stars = F.col("stars")
    return place_sums(df).select(
        *PLACE,
        F.col("reviews").alias("review_count"),
        stars["high"].alias("positive_reviews"),
        stars["low"].alias("negative_reviews"),
        round_half_up(ratio(stars["high"], F.col("reviews")), 3).alias("positive_ratio"),
        round_half_up(_mean_rating(), 2).alias("avg_rating"),
        round_half_up(_deviation(), 2).alias("rating_stddev"),
        round_half_up(_mean("review_length"), 0).alias("avg_review_length"),
        F.col("last_day").alias("latest_review"),
    )


def top_by_avg_rating(stats: DataFrame, n: int = 20) -> DataFrame:
    return stats.orderBy(F.desc("avg_rating"), "place_id", "restaurant_name").limit(n)
