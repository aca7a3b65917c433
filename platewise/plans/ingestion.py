"""End-to-end jobs: ingestion, scoring, recommendations and the stand-alone batch job.

Every hand-over is a DataFrame or a written table; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from platewise import schemas
from platewise.config import RankingParams
from platewise.operators import analysis, cleaning, merge, recommend, scoring, serving, star, stats
from platewise.sources import documents, lake, snapshots


def ingest(
    places: DataFrame,
    as_of=None,
    ingested_at: Column | str | None = None,
    lake_path: str | None = None,
    location: Column | str | None = None,
) -> dict[str, DataFrame]:
    """Place documents to raw, cleaned and star-schema tables, lazily.

    With ``lake_path`` the raw and the featured reviews are written to the raw and the
    processed area of the lake, under the batch's ``location`` and the day of ingestion. A
    rerun of the same batch on that day replaces what it wrote. A location and a day given
    as plain text hold for all rows, which spares the lake a shuffle.
    """
    at = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    raw = documents.flatten_reviews(places, at)
    featured = cleaning.engineer_features(cleaning.clean_reviews(raw), as_of)
    if lake_path:
        if location is None:
            raise ValueError("a batch goes to the lake under its location")
        root = lake_path.rstrip("/")
        lake.write_lake(raw, f"{root}/{lake.RAW_PREFIX}", location, ingested_at)
        lake.write_lake(featured, f"{root}/{lake.PROCESSED_PREFIX}", location, ingested_at)
    return {
        "raw_reviews": raw,
        "restaurants": documents.restaurant_metadata(places, at),
        "reviews": featured,
        "restaurant_stats": stats.restaurant_stats(featured),
        **star.star_schema(featured),
    }


def process_reviews(spark: SparkSession, input_path: str, output_path: str) -> dict:
    """The batch job: JSON in, cleaned reviews and statistics out as Parquet.

    Statistics read the reviews just written, so the text work runs once; row counts
    come from observations on the write itself.
    """
    before, after = Observation(), Observation()
    raw = documents.read_reviews_json(spark, input_path, schemas.JOB_REVIEW)
    cleaned = cleaning.clean_reviews(raw, "job", observe=(before, after))
    featured = cleaning.engineer_features(cleaned, mode="job")
    featured.write.mode("overwrite").parquet(f"{output_path}/reviews")

    reviews = spark.read.schema(featured.schema).parquet(f"{output_path}/reviews")
    per_place = stats.restaurant_stats_job(reviews)
    per_place.write.mode("overwrite").parquet(f"{output_path}/restaurant_stats")
    written = spark.read.schema(per_place.schema).parquet(f"{output_path}/restaurant_stats")
    return {
        "reviews": reviews,
        "restaurant_stats": written,
        "top": stats.top_by_avg_rating(written),
        "input_rows": before.get["rows"],
        "output_rows": after.get["rows"],
    }


def score_backlog(
    raw: DataFrame,
    processed: DataFrame,
    model: scoring.Model,
    model_name: str,
    batch_size: int | None = None,
    predicted_at: Column | None = None,
) -> DataFrame:
    """Score what is not processed yet and merge it into the processed reviews."""
    todo = serving.unprocessed_reviews(raw, processed, batch_size)
    scored = scoring.score_reviews(todo, model, model_name, predicted_at)
    return merge.upsert_processed(processed, scored)


def build_recommendations(
    processed: DataFrame,
    restaurants: DataFrame,
    params: RankingParams = RankingParams(),
    generated_at: Column | None = None,
) -> DataFrame:
    """The stored document of the global list."""
    analyses = analysis.analyze_restaurants(processed, restaurants, params)
    ranked = recommend.recommend(analyses, None, params).withColumn("user_id", F.lit("global"))
    return recommend.recommendation_docs(ranked, generated_at)


def analyze_unscored(
    reviews: DataFrame,
    restaurants: DataFrame | None,
    model: scoring.Model,
    model_name: str,
    params: RankingParams = RankingParams(),
    analyzed_at: Column | None = None,
) -> DataFrame:
    """Score the reviews that have no score yet, then analyse each place over all of its reviews."""
    scored = scoring.ensure_scored(reviews, model, model_name, analyzed_at)
    analyses = analysis.analyze_restaurants(scored, restaurants, params)
    return analyses.withColumn("analyzed_at", F.current_timestamp() if analyzed_at is None else analyzed_at)


def _current(like: DataFrame, path: str) -> DataFrame:
    """The newest version of a table, or one without rows if there is none."""
    spark = like.sparkSession
    return snapshots.read_latest(spark, path) if snapshots.versions(spark, path) else like.filter(F.lit(False))


@contextmanager
def held_on_disk(df: DataFrame) -> Iterator[DataFrame]:
    """Rows that several writes read, made once, on the executors' disks; a part that is lost is made again.

    They stay dealt as they are, so a merge by the key they were dealt by shuffles them no
    further. What the caller holds already is left as it is.
    """
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    df.persist(StorageLevel.DISK_ONLY)
    try:
        yield df
    finally:
        df.unpersist()


def load_warehouse(
    path: str, places: DataFrame, reviews: DataFrame, predictions: DataFrame
) -> dict[str, DataFrame]:
    """Merge a batch into the warehouse below ``path``: dimensions first, then facts.

    Every table gets a new version. Predictions of reviews that are not loaded, by this
    batch or an earlier one, stay out. Copies in the batch are reduced to one per key.
    """

    def stored(table: str, merged: DataFrame) -> DataFrame:
        return snapshots.write_version(merged, f"{path}/{table}")

    place_rows = star.as_warehouse_table(places, "dim_restaurants")
    loaded = {
        "dim_restaurants": stored(
            "dim_restaurants",
            merge.merge_dim_restaurants(_current(place_rows, f"{path}/dim_restaurants"), place_rows),
        )
    }
    with held_on_disk(star.as_warehouse_table(reviews, "fact_reviews")) as review_rows:
        days = star.dim_time(review_rows)
        review_table = review_rows.withColumnRenamed("text_cleaned", "review_text")
        loaded["dim_time"] = stored(
            "dim_time", merge.insert_if_absent(_current(days, f"{path}/dim_time"), days, "full_date")
        )
        loaded["fact_reviews"] = stored(
            "fact_reviews", merge.merge_fact_reviews(_current(review_table, f"{path}/fact_reviews"), review_rows)
        )
    scores = star.as_warehouse_table(predictions, "fact_predictions")
    known = _current(scores, f"{path}/fact_predictions")
    merged = merge.merge_fact_predictions(known, scores, loaded["fact_reviews"])
    return loaded | {"fact_predictions": stored("fact_predictions", merged)}


def refresh_sentiment_summary(restaurants: DataFrame, predictions: DataFrame, path: str) -> DataFrame:
    """Recompute the summary into a new version and return it."""
    return snapshots.write_version(star.sentiment_summary(restaurants, predictions), path)


def refresh_summary_by_batch(
    restaurants: DataFrame, added: DataFrame, path: str, removed: DataFrame | None = None
) -> DataFrame:
    """Bring the summary below ``path`` up to date with a batch of predictions alone.

    ``added`` are the batch's predictions, ``removed`` the rows they replaced, as they were.
    The stored sums per place and the batch are all that is read; the fact table isn't.
    Both the sums and the summary get a new version.
    """
    spark = restaurants.sparkSession
    sums = star.summary_sums(added)
    gone = None if removed is None else star.summary_sums(removed)
    known = f"{path.rstrip('/')}/sums"
    if snapshots.versions(spark, known):
        sums = star.add_sums(snapshots.read_latest(spark, known), sums, gone)
    elif gone is not None:
        raise ValueError("nothing is stored that rows could be removed from")
    sums = snapshots.write_version(sums, known)
    return snapshots.write_version(star.summary_of_sums(restaurants, sums), f"{path.rstrip('/')}/summary")


def refresh_scores_by_batch(
    added: DataFrame,
    path: str,
    as_of: Column | str | None = None,
    removed: DataFrame | None = None,
    params: RankingParams = RankingParams(),
) -> DataFrame:
    """All scores per place on a day, from the sums stored below ``path`` and a batch of scored reviews alone.

    ``removed`` are rows that the batch replaces, as they were. The sums get a new version;
    an empty batch on a later day gives the scores of that day.
    """
    spark = added.sparkSession
    sums = analysis.decayed_sums(added, as_of, params)
    gone = None if removed is None else analysis.decayed_sums(removed, as_of, params)
    if snapshots.versions(spark, path):
        sums = analysis.add_decayed(snapshots.read_latest(spark, path), sums, as_of, gone, params)
    elif gone is not None:
        raise ValueError("nothing is stored that rows could be removed from")
    return analysis.scores_of_sums(snapshots.write_version(sums, path), as_of, params)
