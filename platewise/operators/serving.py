"""Queries behind the lookup, search and recommendation pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.functions.numbers import exact_mean, ratio, round_half_up
from platewise.functions.sentiment import NEGATIVE, POSITIVE, label_count
from platewise.operators import postings as trigrams
from platewise.operators.dedup import top_per_key
from platewise.operators.recommend import numbered

PAGE_SIZE = 20


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of one key; an unknown key gives an empty result."""
    return df.filter(F.col(key) == value)


def lookup_many(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of all requested keys."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def list_restaurants(restaurants: DataFrame, n: int = 100) -> DataFrame:
    return restaurants.orderBy(F.desc("rating"), "place_id").limit(n)


def unprocessed_reviews(raw: DataFrame, processed: DataFrame, batch_size: int | None = 1000) -> DataFrame:
    """Raw reviews without a processed one; ``None`` gives the whole backlog."""
    todo = raw.join(processed.select("review_id"), "review_id", "left_anti")
    return todo if batch_size is None else todo.orderBy("review_id").limit(batch_size)


def place_top_reviews(processed: DataFrame, raw: DataFrame, n: int = 50) -> DataFrame:
    """Best processed reviews of every place; places without any show raw reviews by rating.

    Both sides are cut to ``n`` rows per place before the anti join.
    """
    best = top_per_key(processed, ["place_id"], [F.desc("predicted_score"), F.col("review_id")], n)
    fallback = top_per_key(raw, ["place_id"], [F.desc("rating"), F.col("review_id")], n)
    done = processed.select("place_id").distinct()
    fallback = fallback.join(done, "place_id", "left_anti")
    return best.withColumn("source", F.lit("processed")).unionByName(
        fallback.withColumn("source", F.lit("raw")), allowMissingColumns=True
    )


def _live_stats(processed: DataFrame) -> DataFrame:
    return processed.groupBy("place_id").agg(
        exact_mean(F.col("predicted_score"), 3).alias("mean_score"),
        label_count(F.col("sentiment_label"), POSITIVE).alias("positive_count"),
        label_count(F.col("sentiment_label"), NEGATIVE).alias("negative_count"),
        F.count(F.lit(1)).alias("review_count"),
    )


def search_restaurants(
    restaurants: DataFrame,
    processed: DataFrame,
    q: str = "",
    min_rating: float | None = None,
    min_nlp: float | None = None,
    cuisine: str = "",
    limit: int = PAGE_SIZE,
    postings: DataFrame | None = None,
) -> DataFrame:
    """Places by name and tag pattern, best rated first, with live review statistics.

    ``min_nlp`` is applied after the limit. A filter of 0 or ``''`` is no filter. Only
    the reviews of the listed places are aggregated. With ``postings`` of these places
    (``trigram_postings``) a pattern is tried only on places that hold its trigrams; one
    without trigrams is tried on all. Places need an id then.
    """
    found = restaurants
    if postings is not None:
        for field, pattern in ((trigrams.NAME, q.strip()), (trigrams.TAG, cuisine.strip())):
            may_match = trigrams.candidates(postings, field, pattern)
            if may_match is not None:
                found = found.join(may_match, "place_id", "left_semi")
    if q.strip():
        found = found.filter(F.col("name").rlike(f"(?i){q.strip()}"))
    if min_rating:
        found = found.filter(F.col("rating") >= min_rating)
    if cuisine.strip():
        pattern = f"(?i){cuisine.strip().lower()}"
        found = found.filter(F.exists("types", lambda t: t.rlike(pattern)))
    listed = found.orderBy(F.desc("rating"), "place_id").limit(limit)
    relevant = processed.join(listed.select("place_id"), "place_id", "left_semi")
    out = listed.join(_live_stats(relevant), "place_id", "left").select(
        *[listed[c] for c in restaurants.columns],
        F.coalesce(round_half_up(F.col("mean_score"), 2), F.lit(0.0)).alias("avg_nlp_score"),
        F.coalesce(round_half_up(ratio(F.col("positive_count"), F.col("review_count")), 3), F.lit(0.0)).alias(
            "positive_ratio"
        ),
        F.coalesce("review_count", F.lit(0)).alias("nlp_review_count"),
    )
    return out.filter(F.col("avg_nlp_score") >= min_nlp) if min_nlp else out


def _of_listed(restaurants: DataFrame, listed: DataFrame) -> DataFrame:
    """The places on a short list. A left join keeps the list's side; cutting the places first spares them a shuffle."""
    return restaurants.join(listed.select("place_id"), "place_id", "left_semi")


def _reply(rows: DataFrame, source: str, generated_at: Column | None = None) -> DataFrame:
    """The columns of every recommendation list, whatever it was made from; nothing is null but unknown names' tags."""
    at = F.current_timestamp() if generated_at is None else generated_at
    summary = F.col("sentiment_summary") if "sentiment_summary" in rows.columns else F.lit(None)
    return rows.select(
        "rank",
        "place_id",
        F.coalesce("restaurant_name", F.lit("Unknown")).alias("restaurant_name"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("recommendation_score", "avg_predicted_score")],
        F.coalesce(F.col("review_count").cast("bigint"), F.lit(0).cast("bigint")).alias("review_count"),
        F.coalesce("positive_ratio", F.lit(0.0)).alias("positive_ratio"),
        F.coalesce(summary.cast("map<string,bigint>"), F.create_map().cast("map<string,bigint>")).alias("sentiment_summary"),
        _tags().alias("types"),
        at.cast("string").alias("generated_at"),
        F.lit(source).alias("source"),
    )


def _tags() -> Column:
    return F.coalesce("types", F.array().cast("array<string>"))


def precomputed_recommendations(
    docs: DataFrame,
    restaurants: DataFrame,
    user_id: str = "global",
    min_rating: float | None = None,
    cuisine: str = "",
    limit: int = PAGE_SIZE,
) -> DataFrame:
    """A stored list with current tags; ``cuisine`` is matched as part of a tag."""
    recs = docs.filter(F.col("user_id") == user_id).select(F.inline("recommendations"), "generated_at")
    if min_rating:
        recs = recs.filter(F.coalesce("avg_predicted_score", F.lit(0.0)) >= min_rating)
    out = recs.join(_of_listed(restaurants, recs).select("place_id", "types"), "place_id", "left")
    out = out.withColumn("types", _tags())
    if cuisine.strip():
        part = cuisine.strip().lower()
        out = out.filter(F.exists("types", lambda t: F.lower(t).contains(part)))
    return _reply(out.orderBy("rank", "place_id").limit(limit), "precomputed", F.col("generated_at"))


def live_recommendations(
    processed: DataFrame, restaurants: DataFrame, limit: int = PAGE_SIZE, generated_at: Column | None = None
) -> DataFrame:
    """Best places by the mean score of their processed reviews."""
    best = numbered(_live_stats(processed), [F.desc("mean_score"), F.col("place_id")], limit)
    places = _of_listed(restaurants, best).select("place_id", F.col("name").alias("restaurant_name"), "types")
    score = round_half_up(F.col("mean_score"), 2)
    scored = best.join(places, "place_id", "left").withColumns(
        {
            "avg_predicted_score": score,
            "recommendation_score": score,
            "positive_ratio": round_half_up(ratio(F.col("positive_count"), F.col("review_count")), 3),
        }
    )
    return _reply(scored, "live_nlp", generated_at)


def rating_fallback(
    restaurants: DataFrame, limit: int = PAGE_SIZE, generated_at: Column | None = None
) -> DataFrame:
    """Best rated places, for the time before any review was scored; a missing rating is 0 and comes last."""
    best = numbered(restaurants, [F.desc("rating"), F.col("place_id")], limit)
    rating = F.col("rating").cast("double")
    listed = best.withColumnsRenamed({"name": "restaurant_name", "total_ratings": "review_count"}).withColumns(
        {"avg_predicted_score": rating, "recommendation_score": rating, "positive_ratio": F.lit(0.0)}
    )
    return _reply(listed, "google_rating_fallback", generated_at)


def served_recommendations(
    docs: DataFrame,
    processed: DataFrame,
    restaurants: DataFrame,
    min_rating: float | None = None,
    cuisine: str = "",
    limit: int = PAGE_SIZE,
    generated_at: Column | None = None,
) -> DataFrame:
    """The stored global list, else live statistics, else source ratings; the same columns from each.

    Whether the list is stored is asked of the short table of lists at once. Of the two
    others the plan keeps the first that has rows, out of at most ``2 * limit``.
    """
    if not docs.filter(F.col("user_id") == "global").isEmpty():
        return precomputed_recommendations(docs, restaurants, "global", min_rating, cuisine, limit)
    live = live_recommendations(processed, restaurants, limit, generated_at).withColumn("_choice", F.lit(0))
    rated = rating_fallback(restaurants, limit, generated_at).withColumn("_choice", F.lit(1))
    both = live.unionByName(rated).withColumn("_first", F.min("_choice").over(Window.partitionBy(F.lit(0))))
    return both.filter(F.col("_choice") == F.col("_first")).drop("_choice", "_first")


def display_strip(analytics: DataFrame, n: int = 12) -> DataFrame:
    """The first places of the analytics list."""
    return analytics.orderBy(F.desc_nulls_first("avg_nlp_score"), "place_id").limit(n)
