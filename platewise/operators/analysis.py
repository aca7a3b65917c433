"""Analysis per place: means, Bayesian, recency and hybrid scores, label distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.config import RankingParams
from platewise.functions.dates import as_day
from platewise.functions.numbers import exact_sum, ratio, round_half_up
from platewise.functions.sentiment import POSITIVE


def bayesian_score(score_sum: Column, n: Column, params: RankingParams = RankingParams()) -> Column:
    """Mean pulled towards the prior, by the weight of ``prior_count`` reviews."""
    prior = params.prior_count * params.prior_mean
    return (score_sum.cast("double") + F.lit(float(prior))) / (n + F.lit(params.prior_count))


def recency_weight(age: Column, params: RankingParams = RankingParams()) -> Column:
    days = F.coalesce(age, F.lit(params.default_age_days))
    return F.exp(days * F.lit(-params.decay_rate) / F.lit(float(params.half_life_days)))


def recency_score(weighted_sum: Column, weight_sum: Column) -> Column:
    return weighted_sum / F.greatest(weight_sum, F.lit(1e-8))


def hybrid_score(
    bayesian: Column, recency: Column, n: Column, params: RankingParams = RankingParams()
) -> Column:
    popularity = F.least(n / F.lit(float(params.popularity_saturation)), F.lit(1.0)) * 5
    return (
        bayesian * params.sentiment_weight
        + recency * params.recency_weight
        + popularity * params.popularity_weight
    )


def _per_label(scored: DataFrame, params: RankingParams) -> DataFrame:
    """Partial sums per place and label; one row per label is left of any place."""
    age = F.col("review_age_days") if "review_age_days" in scored.columns else F.lit(None).cast("int")
    weight = recency_weight(age, params)
    return (
        scored.withColumn("_weight", weight)
        .groupBy("place_id", "sentiment_label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            exact_sum(F.col("predicted_score"), 3).alias("score_sum"),
            exact_sum(F.col("confidence"), 4).alias("confidence_sum"),
            F.sum(F.col("predicted_score").cast("double") * F.col("_weight")).alias("weighted_sum"),
            F.sum("_weight").alias("weight_sum"),
        )
    )


def _label_map(label: str, n: str) -> Column:
    """Counts per label, in label order; rows without a label are not in the map."""
    entries = F.collect_list(F.when(F.col(label).isNotNull(), F.struct(F.col(label), F.col(n))))
    return F.map_from_entries(F.array_sort(entries))


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    """Map label -> number of reviews, per place."""
    counts = scored.groupBy("place_id", "sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("place_id").agg(_label_map("sentiment_label", "n").alias("sentiment_distribution"))


def place_scores(scored: DataFrame, params: RankingParams = RankingParams()) -> DataFrame:
    """All scores of each place that has scored reviews.

    A review without a score counts nowhere, neither in means nor in weights; score it
    first (``scoring.ensure_scored``) to have it count.

    Two levels of aggregation: per place and label, then per place. The first combines
    rows inside each task before any shuffle, so a place with very many reviews sends a
    handful of rows per task.
    """
    return _scores(_per_label(scored.filter(F.col("predicted_score").isNotNull()), params), params)


def _scores(per_label: DataFrame, params: RankingParams) -> DataFrame:
    totals = (
        per_label.groupBy("place_id")
        .agg(
            F.sum("n").alias("n"),
            F.sum("score_sum").cast("double").alias("score_sum"),
            F.sum("confidence_sum").cast("double").alias("confidence_sum"),
            recency_score(F.sum("weighted_sum"), F.sum("weight_sum")).alias("recency"),
            F.sum(F.when(F.col("sentiment_label").isin(POSITIVE), F.col("n")).otherwise(0)).alias("positive"),
            _label_map("sentiment_label", "n").alias("sentiment_distribution"),
        )
        .withColumn("bayesian", bayesian_score(F.col("score_sum"), F.col("n"), params))
    )
    n = F.col("n")
    return totals.select(
        "place_id",
        n.alias("review_count"),
        round_half_up(ratio(F.col("score_sum"), n), 3).alias("avg_predicted_score"),
        round_half_up(ratio(F.col("confidence_sum"), n), 3).alias("avg_confidence"),
        round_half_up(F.col("bayesian"), 3).alias("bayesian_score"),
        round_half_up(F.col("recency"), 3).alias("recency_weighted_score"),
        round_half_up(hybrid_score(F.col("bayesian"), F.col("recency"), n, params), 3).alias(
            "recommendation_score"
        ),
        "sentiment_distribution",
        round_half_up(ratio(F.col("positive"), n), 3).alias("positive_ratio"),
    )


EXACT_SUMS = ["n", "score_sum", "confidence_sum", "undated_n", "undated_score_sum"]
DECAYED_SUMS = ["weighted_sum", "weight_sum"]


def decayed_sums(scored: DataFrame, as_of, params: RankingParams = RankingParams()) -> DataFrame:
    """Sums per place and label of which all scores are made, with the day that the weights refer to.

    A weight falls by the same share every day, so sums of weights need not be computed anew
    as time passes: ``add_decayed`` moves them to another day by one factor. Reviews without a
    date (``review_date``) keep the weight of the default age and are counted apart. Reviews
    without a score count nowhere. Reviews after the reference day weigh more than one.
    """
    today, written = as_day(as_of), F.to_date("review_date")
    weight = F.when(written.isNotNull(), recency_weight(F.datediff(today, written), params)).otherwise(0.0)
    score = F.col("predicted_score")
    return (
        scored.filter(score.isNotNull())
        .withColumns({"_weight": weight, "_undated": written.isNull()})
        .groupBy("place_id", "sentiment_label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            exact_sum(score, 3).alias("score_sum"),
            exact_sum(F.col("confidence"), 4).alias("confidence_sum"),
            F.count_if("_undated").alias("undated_n"),
            F.coalesce(exact_sum(F.when(F.col("_undated"), score), 3), F.lit(0).cast("decimal(18,3)")).alias(
                "undated_score_sum"
            ),
            F.sum(score.cast("double") * F.col("_weight")).alias("weighted_sum"),
            F.sum("_weight").alias("weight_sum"),
        )
        .withColumn("reference_day", today)
    )


def add_decayed(
    stored: DataFrame,
    added: DataFrame,
    as_of,
    removed: DataFrame | None = None,
    params: RankingParams = RankingParams(),
) -> DataFrame:
    """The sums of ``stored`` and ``added`` without those of ``removed``, as of a day.

    Counts and plain sums stay exact. Weighted ones are doubles: what is taken off leaves the
    rounding of its own weight behind. Places and labels left without reviews go.
    """
    today = as_day(as_of)
    parts = stored.unionByName(added)
    if removed is not None:
        parts = parts.unionByName(removed.withColumns({c: -F.col(c) for c in EXACT_SUMS + DECAYED_SUMS}))
    kinds = dict(stored.dtypes)
    passed = recency_weight(F.datediff(today, F.col("reference_day")), params)
    return (
        parts.withColumn("_passed", passed)
        .groupBy("place_id", "sentiment_label")
        .agg(
            *[F.sum(c).cast(kinds[c]).alias(c) for c in EXACT_SUMS],
            *[F.sum(F.col(c) * F.col("_passed")).alias(c) for c in DECAYED_SUMS],
        )
        .filter(F.col("n") > 0)
        .withColumn("reference_day", today)
    )


def scores_of_sums(sums: DataFrame, as_of, params: RankingParams = RankingParams()) -> DataFrame:
    """What ``place_scores`` gives for the reviews behind the sums on that day, without reading them."""
    passed = recency_weight(F.datediff(as_day(as_of), F.col("reference_day")), params)
    undated = recency_weight(F.lit(None).cast("int"), params)
    per_label = sums.withColumns(
        {
            "weighted_sum": F.col("weighted_sum") * passed + F.col("undated_score_sum").cast("double") * undated,
            "weight_sum": F.col("weight_sum") * passed + F.col("undated_n") * undated,
        }
    )
    return _scores(per_label, params)


def analyze_restaurants(
    scored: DataFrame,
    restaurants: DataFrame | None = None,
    params: RankingParams = RankingParams(),
    keep_empty: bool = False,
) -> DataFrame:
    """Scores per place with its name and tags, and price level and coordinates where they are known.

    ``keep_empty`` also returns places without reviews, with zeros and an empty map.
    """
    scores = place_scores(scored, params)
    if restaurants is None:
        return scores
    known = [c for c in ("price_level", "latitude", "longitude") if c in restaurants.columns]
    places = restaurants.select("place_id", F.col("name").alias("restaurant_name"), "types", *known)
    joined = places.join(scores, "place_id", "left" if keep_empty else "inner")
    zeros = {
        c: F.coalesce(F.col(c), F.lit(0.0))
        for c in scores.columns
        if c not in ("place_id", "review_count", "sentiment_distribution")
    }
    return joined.withColumns(
        {
            **zeros,
            "review_count": F.coalesce("review_count", F.lit(0)),
            "sentiment_distribution": F.coalesce(
                "sentiment_distribution", F.create_map().cast("map<string,bigint>")
            ),
            "restaurant_name": F.coalesce("restaurant_name", F.lit("Unknown")),
            "types": F.coalesce("types", F.array().cast("array<string>")),
        }
    )


def places_with_reviews(restaurants: DataFrame, processed: DataFrame) -> DataFrame:
    """Every processed review next to its place; places without reviews drop out."""
    return restaurants.join(processed, "place_id")
