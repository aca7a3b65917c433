"""One runnable query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, MapType, StringType, StructField, StructType, TimestampType

from platewise import schemas
from platewise.config import Preferences, RankingParams
from platewise.functions import dates, sentiment, text
from platewise.functions.numbers import round_half_up
from platewise.operators import (
    analysis,
    bi,
    cleaning,
    collaborative,
    dedup,
    merge,
    postings,
    recommend,
    scoring,
    serving,
    star,
    stats,
)
from platewise.plans import bindings as b
from platewise.plans import ingestion
from platewise.session import new_work_path
from platewise.sources import bucketed, documents, json_arrays, lake, lookup, snapshots
from platewise.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

MIN_REVIEWS = 20
PARAMS = RankingParams(min_reviews=MIN_REVIEWS)


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every engine prints alike."""
    out = {}
    for field in df.schema.fields:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, DecimalType):
            out[field.name] = value.cast("double")
        elif isinstance(kind, ArrayType):
            out[field.name] = F.array_join(value, ",")
        elif isinstance(kind, MapType):
            entries = F.transform(F.array_sort(F.map_entries(value)), lambda e: F.concat_ws(":", e["key"], e["value"]))
            out[field.name] = F.array_join(entries, ",")
        elif isinstance(kind, TimestampType):
            out[field.name] = value.cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: round_half_up(F.col(n), digits) for n in names})


def day(name: str) -> Column:
    return F.to_date(name)


# --- sources ---------------------------------------------------------------------------


@query
def scan_reviews_json(spark, sf_dir):
    path = new_work_path(spark, "reviews-json")
    documents.write_reviews_json(b.raw_reviews(spark, sf_dir), path)
    return documents.require_key(documents.read_reviews_json(spark, path), "review_id")


@query
def scan_review_arrays(spark, sf_dir):
    """Files of one array each, read in parts."""
    path = new_work_path(spark, "review-arrays")
    raw = b.raw_reviews(spark, sf_dir)
    json_arrays.write_arrays(raw.select(F.to_json(F.struct(*raw.columns)).alias("document")), "document", path)
    return documents.require_key(json_arrays.read_reviews_arrays(spark, path), "review_id")


@query
def scan_restaurants_json(spark, sf_dir):
    places = b.restaurants(spark, sf_dir).withColumn("extracted_at", F.lit("2024-01-01"))
    lines = places.select(F.to_json(F.struct(*places.columns)).alias("document"))
    return documents.parse_documents(lines, "document", schemas.RESTAURANT)


def _place_documents(spark, sf_dir):
    """Each line item as the document of a place with two reviews, the second one bare."""
    raw = b.raw_reviews(spark, sf_dir)
    full = F.struct(
        F.col("author_name"), F.col("rating"), F.col("text"), F.lit("fr").alias("language"), F.col("time_epoch").alias("time")
    )
    bare = F.struct(
        F.lit(None).cast("string").alias("author_name"),
        F.lit(4.5).alias("rating"),
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("language"),
        F.lit(None).cast("bigint").alias("time"),
    )
    named = F.when(F.col("rating").isNotNull(), F.col("restaurant_name"))
    doc = F.to_json(F.struct("place_id", named.alias("name"), F.array(full, bare).alias("reviews")))
    return documents.parse_documents(raw.select(doc.alias("document")), "document", schemas.PLACE_DETAILS)


@query
def flatten_place_reviews(spark, sf_dir):
    return documents.flatten_reviews(_place_documents(spark, sf_dir), F.lit("2024-01-01"))


@query
def flatten_place_metadata(spark, sf_dir):
    p = b.restaurants(spark, sf_dir)
    location = F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng"))
    doc = F.struct(
        "place_id",
        "name",
        F.when(F.col("price_level").isNotNull(), F.col("address")).alias("formatted_address"),
        F.struct(location.alias("location")).alias("geometry"),
        "rating",
        F.when(F.col("price_level") > 1, F.col("total_ratings")).alias("user_ratings_total"),
        "price_level",
        F.when(F.col("rating") >= 2, F.col("types")).alias("types"),
    )
    lines = p.select(F.to_json(doc).alias("document"))
    places = documents.parse_documents(lines, "document", schemas.PLACE_DETAILS)
    return documents.restaurant_metadata(places, F.lit("2024-01-01"))


@query
def batch_reviews(spark, sf_dir):
    raw = b.raw_reviews(spark, sf_dir)
    batches = raw.select(F.array(F.struct(*raw.columns)).alias("reviews"), F.lit("Tempe").alias("location"))
    return documents.batch_reviews(batches)


def _lake(spark, sf_dir) -> str:
    path = new_work_path(spark, "lake")
    raw = b.raw_reviews(spark, sf_dir)
    month = F.trunc(F.to_date("ingested_at"), "MM")
    place = F.concat(F.lit("New "), F.coalesce(F.col("rating").cast("int").cast("string"), F.lit("Town")))
    lake.write_lake(raw, path, place, month)
    return path


@query
def read_lake_month(spark, sf_dir):
    """The reviews taken in during one month; the folders of other months are not read."""
    rows = lake.read_lake(spark, _lake(spark, sf_dir), schemas.RAW_REVIEW, year=1995, month=6)
    return rows.select("review_id", "place_id", "location", "rating", "time_epoch", "year", "month", "day")


@query
def read_lake_partition(spark, sf_dir):
    rows = lake.read_lake(spark, _lake(spark, sf_dir), schemas.RAW_REVIEW)
    return rows.groupBy("year", "month", "day", "location").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("rating_sum"),
        F.sum("time_epoch").alias("epoch_sum"),
        F.sum(F.length("text")).alias("text_chars"),
    )


@query
def lake_rerun(spark, sf_dir):
    """A location taken in, and again with more reviews: the day's second run replaces the first; read by location."""
    path = new_work_path(spark, "lake-rerun")
    raw = b.raw_reviews(spark, sf_dir)
    year = F.trunc(F.to_date("ingested_at"), "YEAR")
    for rows in (raw.filter("rating < 3"), raw.filter("rating < 5")):
        lake.write_lake(rows, path, F.concat(F.lit("Area "), F.col("rating").cast("int")), year)
    rows = lake.read_lake(spark, path, schemas.RAW_REVIEW, location="Area 2")
    return rows.groupBy("year", "location").agg(F.count(F.lit(1)).alias("n"), F.sum("time_epoch").alias("epoch_sum"))


@query
def lake_processed(spark, sf_dir):
    """Reviews of places, ingested into the raw and the processed area; rows and characters of each by location."""
    path = new_work_path(spark, "lake-areas")
    raw = b.raw_reviews(spark, sf_dir).filter("rating is not null")
    raw = raw.withColumnsRenamed({"time_epoch": "time", "restaurant_name": "name"})
    review = F.struct(*_as_schema(raw, schemas.PLACE_REVIEW))
    places = raw.select("place_id", "name", F.array(review).alias("reviews"))
    places = places.select(*_as_schema(places, schemas.PLACE_DETAILS))
    ingestion.ingest(places, F.lit("2002-01-01").cast("date"), "2024-03-05", path, "Phoenix Downtown")
    found = []
    for area, column in ((lake.RAW_PREFIX, "text"), (lake.PROCESSED_PREFIX, "text_cleaned")):
        rows = lake.read_lake(
            spark, f"{path}/{area}", StructType([StructField(column, StringType())]), 2024, 3, 5, location="Phoenix Downtown"
        )
        counts = F.count(F.lit(1)).alias("n"), F.sum(F.length(column)).alias("chars")
        found.append(rows.groupBy("location").agg(*counts).withColumn("area", F.lit(area)))
    return found[0].unionByName(found[1])


def _as_schema(df, schema):
    """The columns of a schema, null where ``df`` lacks them."""
    return [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]


@query
def lake_files(spark, sf_dir):
    files = lake.lake_files(spark, _lake(spark, sf_dir))
    folder = F.regexp_extract("file_path", r"year=\d+/month=\d+/day=\d+", 0)
    return files.select(folder.alias("folder")).distinct()


@query
def place_reviews(spark, sf_dir):
    asked = b.restaurants(spark, sf_dir).filter(F.col("price_level") == 4)
    return serving.lookup_many(b.predictions(spark, sf_dir), asked, "place_id")


@query
def restaurant_by_id(spark, sf_dir):
    asked = b.reviews_with_copies(spark, sf_dir).filter(F.col("rating") == 5)
    return serving.lookup_many(b.restaurants(spark, sf_dir), asked, "place_id")


@query
def lookup_restaurant(spark, sf_dir):
    """One place by its key."""
    return serving.lookup(b.restaurants(spark, sf_dir), "place_id", "P7")


@query
def lookup_scored_reviews(spark, sf_dir):
    """Predictions of one place, and one by its id, from a table laid out for both."""
    path = new_work_path(spark, "lookup")
    lookup.write_lookup(b.predictions(spark, sf_dir), path, ["place_id", "review_id"], ["review_id"])
    table = spark.read.parquet(path)
    by_id = serving.lookup(table, "review_id", "1-1").withColumn("asked", F.lit("review"))
    return serving.lookup(table, "place_id", "P7").withColumn("asked", F.lit("place")).unionByName(by_id)


@query
def all_restaurants(spark, sf_dir):
    return b.restaurants(spark, sf_dir)


# --- sinks and merges ------------------------------------------------------------------


@query
def parquet_roundtrip(spark, sf_dir):
    source, target = new_work_path(spark, "job-in"), new_work_path(spark, "job-out")
    documents.write_reviews_json(b.raw_reviews(spark, sf_dir), source)
    done = ingestion.process_reviews(spark, source, target)
    return done["reviews"].drop("text", "review_time", "ingested_at")


def _stored_and_arrived(spark, sf_dir):
    """Reviews loaded earlier and a later batch that revises some of them, with copies."""
    copies = b.reviews_with_copies(spark, sf_dir)
    known = dedup.top_per_key(b.stored(copies), ["review_id"], b.latest_first())
    return known, b.arrived(copies)


def _review_documents(spark, sf_dir):
    known, batch = _stored_and_arrived(spark, sf_dir)
    columns = ["review_id", "place_id", "author_name", "rating", "text", "review_date"]
    known = known.withColumn("text", F.concat(F.lit("first by "), F.col("author_name")))
    batch = batch.withColumns(
        {
            "text": F.when(F.col("d") > 0, F.concat(F.lit("again by "), F.col("author_name"))),
            "rating": F.when(F.col("t") % 2 == 0, F.col("rating")).otherwise(F.col("rating") % 5 + 1),
        }
    )
    order = b.latest_first()
    known = known.select(*columns)
    merged = merge.merge_by_key(
        known,
        dedup.top_per_key(batch, ["review_id"], order).select(*columns),
        "review_id",
        keep_if_null=True,
        op_col="op",
    )
    return merged


@query
def upsert_reviews(spark, sf_dir):
    return _review_documents(spark, sf_dir).withColumn("review_date", day("review_date"))


@query
def upsert_review_counts(spark, sf_dir):
    return merge.merge_counts(_review_documents(spark, sf_dir), "op")


def _known_and_new_places(spark, sf_dir):
    p = b.restaurants(spark, sf_dir)
    known = p.filter(F.col("price_level").isNotNull())
    batch = p.filter(F.col("rating") >= 2.5).withColumns(
        {
            "name": F.upper("name"),
            "address": F.when(F.col("total_ratings") > 200, F.concat(F.col("address"), F.lit(" new"))),
            "latitude": F.col("latitude") + 1,
            "total_ratings": F.col("total_ratings") + 1,
        }
    )
    return known, batch


@query
def upsert_restaurants(spark, sf_dir):
    known, batch = _known_and_new_places(spark, sf_dir)
    return merge.upsert_restaurants(known, batch, order_by=[F.col("name")], op_col="op")


@query
def merge_dim_restaurants(spark, sf_dir):
    known, batch = _known_and_new_places(spark, sf_dir)
    known = star.as_warehouse_table(known, "dim_restaurants").withColumn("updated_at", F.lit("2024-01-01"))
    batch = star.as_warehouse_table(batch, "dim_restaurants").withColumn("updated_at", F.lit("2024-02-01"))
    return merge.merge_dim_restaurants(known, batch, order_by=[F.col("name")])


def _fact_rows(df: DataFrame, loaded_at: str) -> DataFrame:
    return df.select(
        "review_id",
        "place_id",
        "author_name",
        F.col("rating").cast("decimal(3,2)").alias("rating"),
        F.when(F.col("d") > 2, F.concat(F.lit("t"), F.col("d"))).alias("text_cleaned"),
        F.col("q").cast("int").alias("review_length"),
        F.col("t").alias("word_count"),
        day("review_date").alias("review_date"),
        F.datediff(F.lit("2002-01-01").cast("date"), day("review_date")).alias("review_age_days"),
        F.lit(loaded_at).alias("loaded_at"),
    )


@query
def merge_fact_reviews(spark, sf_dir):
    known, batch = _stored_and_arrived(spark, sf_dir)
    target = _fact_rows(known, "2024-01-01").withColumnRenamed("text_cleaned", "review_text")
    winners = dedup.top_per_key(batch, ["review_id"], b.latest_first())
    return merge.merge_fact_reviews(target, _fact_rows(winners, "2024-02-01"))


@query
def merge_bucketed(spark, sf_dir):
    """The same merge of reviews into a table bucketed by their id."""
    known, batch = _stored_and_arrived(spark, sf_dir)
    table = bucketed.BucketedTable(new_work_path(spark, "bucketed"), "review_id", 16)
    bucketed.write(_fact_rows(known, "2024-01-01").withColumnRenamed("text_cleaned", "review_text"), table)
    winners = dedup.top_per_key(batch, ["review_id"], b.latest_first())
    arrived = _fact_rows(winners, "2024-02-01")
    arrived = arrived.withColumn("review_text", F.coalesce("text_cleaned", F.lit(""))).drop("text_cleaned")
    return bucketed.merge_into(table, arrived, update_cols=merge.FACT_REVIEW_UPDATES)


@query
def backlog_bucketed(spark, sf_dir):
    """The reviews without a stored prediction, of two tables bucketed by review id."""
    path = new_work_path(spark, "bucketed")
    reviews = b.reviews(spark, sf_dir)
    done = bucketed.write(b.stored(reviews).select("review_id"), bucketed.BucketedTable(f"{path}/done", "review_id", 16))
    known = reviews.select("review_id", "place_id", "rating", day("review_date").alias("review_date"))
    known = bucketed.write(known, bucketed.BucketedTable(f"{path}/reviews", "review_id", 16))
    return serving.unprocessed_reviews(known, done, None)


@query
def merge_dim_time(spark, sf_dir):
    known, batch = _stored_and_arrived(spark, sf_dir)
    target = star.dim_time(known).withColumn("week_of_year", F.lit(0))
    return merge.insert_if_absent(target, star.dim_time(batch), "full_date")


def _known_and_new_predictions(spark, sf_dir, reviews=None):
    all_reviews = b.with_prediction(b.reviews(spark, sf_dir) if reviews is None else reviews)
    known = b.stored(all_reviews).select(*b.PREDICTION_COLUMNS)
    batch = b.arrived(all_reviews).withColumns(
        {
            "predicted_score": F.least(F.col("predicted_score") + F.lit(0.25), F.lit(5.0)).cast("decimal(3,2)"),
            "place_id": F.concat(F.col("place_id"), F.lit("x")),
            "model_version": F.lit("bound-v2"),
        }
    )
    return all_reviews, known, batch.select(*b.PREDICTION_COLUMNS, "rating")


@query
def upsert_processed(spark, sf_dir):
    _, known, batch = _known_and_new_predictions(spark, sf_dir)
    return merge.upsert_processed(known, batch.drop("rating"), order_by=[F.desc("predicted_score")])


def _loaded(all_reviews):
    """Reviews that reached the warehouse: the well rated ones."""
    return all_reviews.filter(F.col("rating") >= 3)


@query
def merge_fact_predictions(spark, sf_dir):
    all_reviews, known, batch = _known_and_new_predictions(spark, sf_dir)
    return merge.merge_fact_predictions(known, batch.drop("rating"), _loaded(all_reviews))


@query
def merge_small_batch(spark, sf_dir):
    """The same merge in the shape for batches far smaller than the target."""
    _, known, batch = _known_and_new_predictions(spark, sf_dir)
    return merge.merge_by_key(
        known,
        batch.drop("rating"),
        "review_id",
        merge.FACT_PREDICTION_UPDATES,
        op_col="op",
        small_updates=True,
    )


@query
def fk_rejects(spark, sf_dir):
    all_reviews, _, batch = _known_and_new_predictions(spark, sf_dir)
    _, rejected = merge.split_by_reference(batch.drop("rating"), _loaded(all_reviews), "review_id")
    return rejected


@query
def load_warehouse(spark, sf_dir):
    """Two loads, of which the second knows the well rated reviews only; rows and sums of each table."""
    path = new_work_path(spark, "warehouse")
    known_places, new_places = _known_and_new_places(spark, sf_dir)
    known, batch = _stored_and_arrived(spark, sf_dir)
    arrived = dedup.top_per_key(batch, ["review_id"], b.latest_first()).filter("rating >= 3")
    # both loads read the predictions of the same reviews
    with ingestion.held_on_disk(b.reviews(spark, sf_dir).drop("author_name")) as reviews:
        _, scored, new_scored = _known_and_new_predictions(spark, sf_dir, reviews)
        when = {"updated_at": F.lit("2024-01-01")}
        ingestion.load_warehouse(path, known_places.withColumns(when), _fact_rows(known, "2024-01-01"), scored)
        when = {"updated_at": F.lit("2024-02-01")}
        tables = ingestion.load_warehouse(
            path, new_places.withColumns(when), _fact_rows(arrived, "2024-02-01"), new_scored.drop("rating")
        )
    measures = {
        "dim_restaurants": F.sum("total_ratings"),
        "dim_time": F.sum("day_of_week"),
        "fact_reviews": F.sum(F.col("rating") * 100),
        "fact_predictions": F.sum(F.col("predicted_score") * 100),
    }
    counted = [
        tables[name].agg(F.count(F.lit(1)).alias("n"), total.cast("bigint").alias("total")).withColumn("table_name", F.lit(name))
        for name, total in measures.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


@query
def upsert_preferences(spark, sf_dir):
    users = b.user_preferences(spark, sf_dir)
    known = users.filter(F.col("c_nationkey") < 15).drop("c_nationkey")
    known = known.withColumns(
        {
            "cuisine_types": F.array(F.lit("old")),
            "price_range": F.array(F.lit(1), F.lit(4)),
            "updated_at": F.lit("2023-12-31T00:00:00"),
        }
    )
    sent = users.filter(F.col("c_nationkey") >= 10).withColumn(
        "user_id", F.when(F.col("c_nationkey") < 24, F.col("user_id"))
    )
    price = F.when(F.col("c_nationkey") % 3 == 0, F.array(F.lit(1), (1 + F.col("c_nationkey") % 4).cast("int")))
    sent = sent.withColumn("price_range", price)
    order = [F.desc("min_rating"), F.array_join("cuisine_types", ","), F.col("price_range")[1].asc_nulls_first()]
    return merge.upsert_preferences(known, sent.drop("c_nationkey"), order, F.lit("2024-01-01T00:00:00"))


# --- warehouse and business queries ----------------------------------------------------


@query
def star_dim_time(spark, sf_dir):
    return star.dim_time(b.reviews(spark, sf_dir))


@query
def star_dim_restaurants(spark, sf_dir):
    return star.dim_restaurants(_featured(spark, sf_dir))


@query
def star_fact_reviews(spark, sf_dir):
    return star.as_warehouse_table(star.fact_reviews(_featured(spark, sf_dir)), "fact_reviews")


@query
def dim_users(spark, sf_dir):
    users = star.dim_users(b.reviews(spark, sf_dir))
    return users.withColumn("first_seen", day("first_seen"))


def _summary(spark, sf_dir):
    return star.sentiment_summary(b.restaurants(spark, sf_dir), b.predictions(spark, sf_dir))


@query
def mv_restaurant_sentiment(spark, sf_dir):
    path = new_work_path(spark, "sentiment-summary")
    ingestion.refresh_sentiment_summary(b.restaurants(spark, sf_dir), b.predictions(spark, sf_dir), path)
    return snapshots.read_latest(spark, path)


@query
def mv_refresh_by_batch(spark, sf_dir):
    """The summary after a first load with other scores of some reviews, and a batch that revises these and adds more."""
    path = new_work_path(spark, "summary-by-batch")
    places = b.restaurants(spark, sf_dir)
    scored = b.with_prediction(b.reviews(spark, sf_dir))
    early = b.stored(scored).select(*b.PREDICTION_COLUMNS, "review_date")
    other = F.col("review_date") >= F.lit(b.ARRIVED_SINCE).cast("timestamp_ntz")
    first = early.withColumns(
        {
            "predicted_score": F.when(other, F.lit(1).cast("decimal(3,2)")).otherwise(F.col("predicted_score")),
            "sentiment_label": F.when(other, "neutral").otherwise(F.col("sentiment_label")),
        }
    )
    ingestion.refresh_summary_by_batch(places, first, path)
    # the rows as the merge of the batch found them
    return ingestion.refresh_summary_by_batch(places, b.arrived(scored), path, first.filter(other))


@query
def top_restaurants_by_nlp(spark, sf_dir):
    path = new_work_path(spark, "sentiment-summary")
    summary = ingestion.refresh_sentiment_summary(
        b.restaurants(spark, sf_dir), b.predictions(spark, sf_dir), path
    )
    return bi.top_restaurants_by_nlp(summary, MIN_REVIEWS)


@query
def sentiment_over_time(spark, sf_dir):
    fact = b.reviews(spark, sf_dir)
    return bi.sentiment_over_time(b.predictions(spark, sf_dir), fact, star.dim_time(b.reviews_with_copies(spark, sf_dir)))


@query
def score_vs_rating(spark, sf_dir):
    return bi.score_vs_rating(_summary(spark, sf_dir), MIN_REVIEWS)


@query
def review_volume_trend(spark, sf_dir):
    today = b.as_of(spark, sf_dir)
    since = today - timedelta(days=90)
    return rounded(
        bi.review_volume_trend(
            b.predictions(spark, sf_dir, since), b.reviews(spark, sf_dir, since), F.lit(today)
        ),
        6,
        "rolling_7d_avg",
    )


@query
def price_vs_sentiment(spark, sf_dir):
    return bi.price_vs_sentiment(_summary(spark, sf_dir))


@query
def confidence_tiers(spark, sf_dir):
    return bi.confidence_tiers(b.predictions(spark, sf_dir), b.reviews(spark, sf_dir))


@query
def sentiment_analytics_wh(spark, sf_dir):
    return bi.sentiment_analytics_warehouse(
        b.predictions(spark, sf_dir), b.reviews(spark, sf_dir), b.restaurants(spark, sf_dir)
    )


@query
def sentiment_analytics_api(spark, sf_dir):
    return bi.sentiment_analytics_api(
        b.predictions(spark, sf_dir), b.reviews(spark, sf_dir), b.restaurants(spark, sf_dir), MIN_REVIEWS
    )


@query
def analytics_strip(spark, sf_dir):
    return serving.display_strip(sentiment_analytics_api(spark, sf_dir))


@query
def table_counts(spark, sf_dir):
    return bi.table_counts(
        {
            "restaurants": b.restaurants(spark, sf_dir),
            "raw_reviews": b.reviews_with_copies(spark, sf_dir),
            "processed_reviews": b.reviews(spark, sf_dir).select("review_id"),
            "user_preferences": b.user_preferences(spark, sf_dir),
            "texts": b.texts(spark, sf_dir),
        }
    )


@query
def geo_grid_quality(spark, sf_dir):
    return bi.geo_grid_quality(b.restaurants(spark, sf_dir), _summary(spark, sf_dir))


@query
def credibility_score(spark, sf_dir):
    scored = b.processed(spark, sf_dir)
    return bi.credibility_score(scored, star.dim_users(scored))


@query
def volume_anomalies(spark, sf_dir):
    days = b.table(spark, sf_dir, "events").groupBy(day("ts").alias("day")).agg(F.count(F.lit(1)).alias("volume"))
    return rounded(bi.volume_anomalies(days), 6, "trailing_mean", "trailing_std", "z_score")


# --- cleaning, features, statistics ----------------------------------------------------


@query
def dedup_reviews(spark, sf_dir):
    return dedup.dedup_reviews(b.raw_reviews(spark, sf_dir))


CLEAN_COLUMNS = ["review_id", "place_id", "rating", "text_cleaned", "review_date"]


@query
def clean_reviews(spark, sf_dir):
    return cleaning.clean_reviews(b.raw_reviews(spark, sf_dir)).select(*CLEAN_COLUMNS)


@query
def clean_reviews_job(spark, sf_dir):
    return cleaning.clean_reviews(b.raw_reviews(spark, sf_dir), "job").select(*CLEAN_COLUMNS)


@query
def clean_counts(spark, sf_dir):
    raw = b.raw_reviews(spark, sf_dir)
    return cleaning.clean_counts(raw)


@query
def clean_batch_counts(spark, sf_dir):
    return cleaning.batch_text_counts(b.texts(spark, sf_dir))


AS_OF = "2024-06-01"


def _featured(spark, sf_dir):
    return cleaning.engineer_features(cleaning.clean_reviews(b.raw_reviews(spark, sf_dir)), F.lit("2002-01-01").cast("date"))


@query
def engineer_features(spark, sf_dir):
    """Features of the long texts, which the sources of many documents share."""
    cleaned = cleaning.clean_reviews(b.texts(spark, sf_dir))
    return cleaning.engineer_features(cleaned, F.lit(AS_OF).cast("date")).drop("text", "text_cleaned", "doc_id")


@query
def restaurant_stats(spark, sf_dir):
    out = stats.restaurant_stats(_featured(spark, sf_dir))
    return rounded(
        out, 6, "avg_rating", "rating_stddev", "avg_review_length", "avg_word_count", "positive_ratio"
    )


@query
def restaurant_stats_job(spark, sf_dir):
    cleaned = cleaning.clean_reviews(b.raw_reviews(spark, sf_dir), "job")
    featured = cleaning.engineer_features(cleaned, mode="job")
    return stats.restaurant_stats_job(featured)


@query
def top_by_avg_rating(spark, sf_dir):
    out = stats.restaurant_stats(_featured(spark, sf_dir))
    top = stats.top_by_avg_rating(rounded(out, 6, "avg_rating"), 20)
    return top.select("place_id", "restaurant_name", "review_count", "avg_rating")


@query
def rating_category(spark, sf_dir):
    r = dedup.dedup_reviews(b.raw_reviews(spark, sf_dir))
    return r.select("review_id", "rating", sentiment.rating_category(F.col("rating")).alias("rating_category"))


@query
def date_parts(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", day("o_orderdate").alias("full_date"))
    return orders.withColumns(dates.date_parts(F.col("full_date")))


# --- text and scoring ------------------------------------------------------------------


@query
def normalize_text(spark, sf_dir):
    return b.texts(spark, sf_dir).select("review_id", text.normalize_text(F.col("text")).alias("text_cleaned"))


@query
def truncate_words(spark, sf_dir):
    whole = text.normalize_text(F.col("text"))
    return b.texts(spark, sf_dir).select("review_id", text.truncate_words(whole, 10).alias("first_words"))


@query
def key_phrases(spark, sf_dir):
    phrases = text.key_phrases(text.normalize_text(F.col("text")))
    return b.texts(spark, sf_dir).select("review_id", phrases.alias("key_phrases"))


@query
def display_types(spark, sf_dir):
    tag = (
        F.when(F.col("p_type") == "PROMO", "meal_takeaway")
        .when(F.col("p_type") == "ECONOMY", "food")
        .when(F.col("p_type") == "SMALL", "cafe")
        .when(F.col("p_type") == "LARGE", "night_club")
        .when(F.col("p_type") == "MEDIUM", "point_of_interest")
        .otherwise("grocery_or_supermarket")
    )
    other = F.when(F.col("p_size") > 25, F.replace("p_name", F.lit(" "), F.lit("_"))).otherwise("establishment")
    tags = F.array(F.lit("store"), tag, other)
    return b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("place"), text.display_types(tags).alias("labels")
    )


@query
def score_class(spark, sf_dir):
    r = b.processed(spark, sf_dir)
    score = F.when(F.col("rating") != 3, F.col("predicted_score")).otherwise(F.lit(0).cast("decimal(3,2)"))
    return r.select("review_id", sentiment.score_class(score, F.col("rating")).alias("score_class"))


@query
def score_from_logits(spark, sf_dir):
    scored = scoring.score_from_logits(b.logits(spark, sf_dir))
    return scored.drop("logits")


def _stored_model(spark, sf_dir):
    return scoring.stored_logits(b.logits(spark, sf_dir), "doc_id", "logits")


def _at():
    return F.lit("2024-01-01")


SCORED = [
    "review_id",
    "predicted_score",
    "sentiment_label",
    "confidence",
    "text_cleaned",
    "model_version",
    "predicted_at",
    "key_phrases",
]


@query
def score_reviews(spark, sf_dir):
    """Scores from stored model outputs; texts without any count as neutral."""
    out = scoring.score_reviews(b.texts(spark, sf_dir), _stored_model(spark, sf_dir), "team/five-class", _at())
    return out.select(*SCORED)


def _keyword_model():
    """Loader of a tiny scorer for the batch interface: words for and against."""

    def load():
        classes = np.arange(1, 6, dtype=float)

        def predict(batch: list[str]) -> np.ndarray:
            lean = [t.count("great") - t.count("slow") + t.count("pizza") for t in batch]
            return -np.abs(classes[None, :] - 3.0 - np.array(lean, dtype=float)[:, None])

        return predict

    return load


@query
def score_reviews_batched(spark, sf_dir):
    model = scoring.batch_model(_keyword_model())
    out = scoring.score_reviews(b.texts(spark, sf_dir), model, "team/keywords", _at())
    return out.select("review_id", "predicted_score", "sentiment_label", "confidence", "model_version")


def trained_scores(spark, sf_dir):
    """The default model, trained on the labelled texts and applied to all texts."""
    all_texts = b.texts(spark, sf_dir).drop("rating")
    rated = all_texts.join(b.text_ratings(spark, sf_dir), "doc_id")
    model = scoring.train_bag_of_words(rated)
    out = scoring.score_reviews(all_texts, model, "local/bag-of-words", _at())
    return out.select("review_id", "text_cleaned", "predicted_score", "sentiment_label", "confidence", "model_version")


@query
def score_reviews_trained(spark, sf_dir):
    """What any trained model has to give: neutral scores of blank texts, and scores, labels and shares in their ranges."""
    blank = F.col("text_cleaned") == ""
    own = {c: F.when(blank, F.col(c)).alias(c) for c in ("predicted_score", "sentiment_label", "confidence")}
    return trained_scores(spark, sf_dir).select(
        "review_id",
        *own.values(),
        F.col("predicted_score").between(1, 5).alias("score_in_range"),
        F.col("sentiment_label").isin(sentiment.LABELS).alias("label_known"),
        (blank | F.col("confidence").between(0.2, 1)).alias("confidence_in_range"),
        "model_version",
    )


def _partly_scored(spark, sf_dir):
    """Texts of which the labelled ones have a score already, without confidence."""
    known = b.text_ratings(spark, sf_dir).select("doc_id", F.col("rating").alias("predicted_score"))
    label = F.when(F.col("predicted_score") >= 4, "positive").when(F.col("predicted_score") < 3, "negative")
    return (
        b.texts(spark, sf_dir)
        .join(known, "doc_id", "left")
        .withColumn("sentiment", F.when(F.col("predicted_score").isNotNull(), F.coalesce(label, F.lit("neutral"))))
        .withColumn("confidence", F.when(F.col("predicted_score") > 4, 0.75))
    )


@query
def ensure_scored(spark, sf_dir):
    out = scoring.ensure_scored(_partly_scored(spark, sf_dir), _stored_model(spark, sf_dir), "team/five-class", _at())
    return out.select("review_id", "predicted_score", "sentiment_label", "confidence", "model_version")


@query
def analyze_partly_scored(spark, sf_dir):
    """Texts without a score are scored before their places are analysed."""
    reviews = _partly_scored(spark, sf_dir).withColumn(
        "review_age_days", (F.abs("doc_id") % 200).cast("int")
    )
    return ingestion.analyze_unscored(
        reviews, None, _stored_model(spark, sf_dir), "team/five-class", PARAMS, _at()
    )


@query
def score_backlog(spark, sf_dir):
    """Score the texts without a stored result and merge them into the processed ones."""
    raw = b.texts(spark, sf_dir)
    done = (
        raw.join(b.text_ratings(spark, sf_dir).withColumnRenamed("rating", "predicted_score"), "doc_id")
        .select("review_id", "place_id", "predicted_score", F.lit("known").alias("sentiment_label"))
    )
    merged = ingestion.score_backlog(raw, done, _stored_model(spark, sf_dir), "team/five-class", None, _at())
    return merged.select("review_id", "place_id", "predicted_score", "sentiment_label", "model_version")


@query
def prediction_rows(spark, sf_dir):
    """Scored texts as rows of the predictions table, with its two digits of score."""
    scored = scoring.score_reviews(b.texts(spark, sf_dir), _stored_model(spark, sf_dir), "team/five-class", _at())
    return star.prediction_rows(scored)


@query
def batch_summary(spark, sf_dir):
    return scoring.batch_summary(score_reviews(spark, sf_dir))


# --- analysis, ranking, recommendations ------------------------------------------------


def _aged(spark, sf_dir):
    return b.processed(spark, sf_dir, b.as_of(spark, sf_dir))


def _analyses(spark, sf_dir):
    return analysis.analyze_restaurants(_aged(spark, sf_dir), b.restaurants(spark, sf_dir), PARAMS)


@query
def analyze_restaurants(spark, sf_dir):
    """All places, with one for each supplier, which nobody has reviewed."""
    places = b.restaurants(spark, sf_dir).select("place_id", "name", "types")
    empty = b.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("N"), "s_suppkey").alias("place_id"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("array<string>").alias("types"),
    )
    return analysis.analyze_restaurants(_aged(spark, sf_dir), places.unionByName(empty), PARAMS, keep_empty=True)


@query
def sentiment_distribution(spark, sf_dir):
    return analysis.sentiment_distribution(b.processed(spark, sf_dir))


@query
def bayesian_score(spark, sf_dir):
    return analysis.place_scores(b.processed(spark, sf_dir)).select("place_id", "review_count", "bayesian_score")


@query
def recency_score(spark, sf_dir):
    return analysis.place_scores(_aged(spark, sf_dir)).select("place_id", "recency_weighted_score")


@query
def place_scores_by_batch(spark, sf_dir):
    """Scores after a first load, a batch two years later that revises and adds, and a day without reviews."""
    path = new_work_path(spark, "scores-by-batch")
    scored = b.processed(spark, sf_dir)
    other = F.col("review_date") >= F.lit(b.ARRIVED_SINCE).cast("timestamp_ntz")
    revised = {
        "predicted_score": F.when(other, F.lit(1).cast("decimal(3,2)")).otherwise(F.col("predicted_score")),
        "sentiment_label": F.when(other, "neutral").otherwise(F.col("sentiment_label")),
    }
    first = b.stored(scored).withColumns(revised)
    ingestion.refresh_scores_by_batch(first, path, b.ARRIVED_SINCE, params=PARAMS)
    ingestion.refresh_scores_by_batch(b.arrived(scored), path, b.STORED_BEFORE, first.filter(other), PARAMS)
    last = F.lit(b.as_of(spark, sf_dir))
    return ingestion.refresh_scores_by_batch(scored.limit(0), path, last, params=PARAMS).drop("sentiment_distribution")


@query
def places_with_reviews(spark, sf_dir):
    joined = analysis.places_with_reviews(
        b.restaurants(spark, sf_dir), b.processed(spark, sf_dir).withColumnRenamed("rating", "stars")
    )
    return joined.select("place_id", "name", "types", "review_id", "stars", "predicted_score", "sentiment_label")


@query
def rank_restaurants(spark, sf_dir):
    ranked = recommend.rank_restaurants(_analyses(spark, sf_dir), PARAMS)
    return ranked.select("rank", "place_id", "recommendation_score", "review_count")


@query
def global_recommendations(spark, sf_dir):
    return recommend.recommend(_analyses(spark, sf_dir), None, PARAMS)


@query
def recommend_for_user(spark, sf_dir):
    prefs = Preferences(min_rating=3.0, cuisine_types=("Small", "gear"))
    return recommend.recommend(_analyses(spark, sf_dir), prefs, PARAMS)


@query
def recommend_for_users(spark, sf_dir):
    out = recommend.recommend_for_users(_analyses(spark, sf_dir), b.user_preferences(spark, sf_dir), PARAMS)
    return out.drop("sentiment_summary")


def _order_ratings(spark, sf_dir):
    """What customers think of the parts they ordered, as ratings from 1 to 5."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("U"), "o_custkey").alias("user_id"))
    # lines are summed per order and place before the join, so a huge order stays small
    lines = (
        b.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("P"), "l_partkey").alias("place_id"))
        .agg(F.sum(1 + F.col("l_quantity").cast("int") % 5).alias("total"), F.count(F.lit(1)).alias("n"))
    )
    return (
        lines.join(orders, "o_orderkey")
        .groupBy("user_id", "place_id")
        .agg((F.sum("total") / F.sum("n")).alias("rating"))
    )


def ordered_lists(spark, sf_dir):
    """Each customer's list, ordered by what customers with similar orders rate well."""
    factors = collaborative.train_factors(_order_ratings(spark, sf_dir), "user_id", "place_id", "rating")
    lists = recommend.recommend_for_users(_analyses(spark, sf_dir), b.user_preferences(spark, sf_dir), PARAMS)
    ordered = collaborative.order_candidates(factors, lists)
    return ordered.select("user_id", "place_id", "rank", "predicted_rating", "position")


def order_errors(spark, sf_dir):
    """Errors on the held-out ratings, with the regularisation that suits them best."""
    rated = _order_ratings(spark, sf_dir)
    _, factors = collaborative.choose_factors(rated, "user_id", "place_id", "rating", (0.1, 2.0))
    return collaborative.prediction_errors(factors, rated.filter(collaborative.held_out("user_id", "place_id")), "rating")


@query
def als_errors(spark, sf_dir):
    """What any factors have to give: the pairs held out and covered, the mean's error, and a model that is not far off it.

    Ratings follow from order quantities, which nobody's taste explains, so the mean is
    about as good as any answer; a model that only learns noise is clearly worse.
    """
    errors = rounded(order_errors(spark, sf_dir), 6, "rmse_mean")
    return errors.select("held", "covered", "rmse_mean", (F.col("rmse") < 1.05 * F.col("rmse_mean")).alias("near_mean"))


def best_new_places(spark, sf_dir):
    """Ten places for each customer, of all that anybody ordered, that they haven't ordered themselves."""
    rated = _order_ratings(spark, sf_dir)
    factors = collaborative.train_factors(rated, "user_id", "place_id", "rating")
    return collaborative.top_places(factors, 10, seen=rated)


@query
def als_new_places(spark, sf_dir):
    """What any factors have to give: each customer's number of new places, positions without gaps, none known already."""
    found = best_new_places(spark, sf_dir)
    known = _order_ratings(spark, sf_dir).select("user_id", "place_id", F.lit(1).alias("known"))
    joined = found.join(known, ["user_id", "place_id"], "left")
    return joined.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_places"),
        F.count_distinct("place_id").alias("n_distinct"),
        F.max("position").alias("last_position"),
        F.count("known").alias("n_known"),
    )


@query
def als_recommendations(spark, sf_dir):
    """What any factors have to give: all candidates, a rating for known users, and positions from 1 without gaps or ties."""
    one_list = Window.partitionBy("user_id")
    return ordered_lists(spark, sf_dir).select(
        "user_id",
        "place_id",
        "rank",
        F.col("predicted_rating").isNotNull().alias("rated"),
        F.max("position").over(one_list).alias("last_position"),
        F.size(F.collect_set("position").over(one_list)).alias("n_positions"),
    )


@query
def recommend_price_location(spark, sf_dir):
    params = RankingParams(min_reviews=MIN_REVIEWS, top_n=200)
    prefs = Preferences(price_range=(2, 4), near=(33.4255, -111.94), max_km=60.0)
    ranked = recommend.rank_restaurants(_analyses(spark, sf_dir), params)
    return recommend.apply_preferences(ranked, prefs).select("rank", "place_id", "recommendation_score", "price_level")


@query
def recommend_nearby(spark, sf_dir):
    """Each customer's five best places within 2 to 11 km."""
    users = b.user_preferences(spark, sf_dir).select(
        "user_id",
        "min_rating",
        F.array(33 + F.substring("user_id", 2, 20).cast("int") % 97 / 97, -112 + F.substring("user_id", 2, 20).cast("int") % 67 / 97).alias("near"),
        F.when(F.col("c_nationkey") != 3, (2 + F.col("c_nationkey") % 10).cast("double")).alias("max_km"),
    )
    return recommend.recommend_nearby(_analyses(spark, sf_dir), users, PARAMS, n=5)


@query
def recommendation_docs(spark, sf_dir):
    recs = recommend.recommend_for_users(_analyses(spark, sf_dir), b.user_preferences(spark, sf_dir), PARAMS)
    docs = recommend.recommendation_docs(recs, _at())
    entry = F.transform("recommendations", lambda r: F.concat_ws(":", r["rank"], r["place_id"]))
    return docs.select("user_id", entry.alias("recommendations"), "generated_at")


@query
def upsert_recommendations(spark, sf_dir):
    """New lists of the users a rerun covers replace their stored lists."""
    recs = recommend.recommend_for_users(_analyses(spark, sf_dir), b.user_preferences(spark, sf_dir), PARAMS)
    stored = recommend.recommendation_docs(recs.filter(F.col("rank") <= 10), F.lit("2023-12-31"))
    new = recommend.recommendation_docs(recs.filter(F.col("recommendation_score") >= 2.9), _at())
    docs = merge.upsert_recommendations(stored, new)
    entry = F.transform("recommendations", lambda r: F.concat_ws(":", r["rank"], r["place_id"]))
    return docs.select("user_id", entry.alias("recommendations"), "generated_at")


def _docs(spark, sf_dir):
    """The global list, stored as the recommendation job leaves it."""
    docs = ingestion.build_recommendations(
        _aged(spark, sf_dir), b.restaurants(spark, sf_dir), RankingParams(min_reviews=MIN_REVIEWS, top_n=200), _at()
    )
    return snapshots.write_version(docs, new_work_path(spark, "recommendations"))


def _no_docs(spark):
    return spark.createDataFrame([], "user_id string, recommendations array<struct<rank: int>>, generated_at string")


@query
def served_recommendations(spark, sf_dir):
    served = serving.served_recommendations(
        _docs(spark, sf_dir),
        b.processed(spark, sf_dir),
        b.restaurants(spark, sf_dir),
        min_rating=2.9,
        cuisine="Mall",
        limit=40,
    )
    return served.drop("sentiment_summary")


@query
def live_recommendations(spark, sf_dir):
    served = serving.served_recommendations(
        _no_docs(spark), b.processed(spark, sf_dir), b.restaurants(spark, sf_dir), generated_at=_at()
    )
    return served.drop("sentiment_summary")


@query
def rating_fallback(spark, sf_dir):
    """Nothing is scored; the places whose rating ends in 0 have none."""
    scored = b.processed(spark, sf_dir).filter(F.col("predicted_score").isNull())
    rating = F.when(F.col("rating") * 100 % 10 != 0, F.col("rating"))
    places = b.restaurants(spark, sf_dir).withColumn("rating", rating)
    served = serving.served_recommendations(_no_docs(spark), scored, places, generated_at=_at())
    return served.drop("sentiment_summary")


# --- serving ---------------------------------------------------------------------------


@query
def search_restaurants(spark, sf_dir):
    return serving.search_restaurants(
        b.restaurants(spark, sf_dir),
        b.predictions(spark, sf_dir),
        q="BOLT|gear",
        min_rating=2.0,
        min_nlp=2.9,
        cuisine="sm",
        limit=100,
    )


@query
def search_by_postings(spark, sf_dir):
    places = b.restaurants(spark, sf_dir)
    path = new_work_path(spark, "postings")
    lookup.write_lookup(postings.trigram_postings(places), path, ["field", "gram", "place_id"])
    return serving.search_restaurants(
        places, b.predictions(spark, sf_dir), q="BOLT|gear", cuisine="Small", limit=100, postings=spark.read.parquet(path)
    )


@query
def list_restaurants(spark, sf_dir):
    return serving.list_restaurants(b.restaurants(spark, sf_dir))


@query
def unprocessed_reviews(spark, sf_dir):
    r = b.reviews(spark, sf_dir)
    todo = serving.unprocessed_reviews(r, b.stored(r), None)
    return todo.select("review_id", "place_id", "rating", day("review_date").alias("review_date"))


@query
def unprocessed_batch(spark, sf_dir):
    r = b.reviews(spark, sf_dir)
    return serving.unprocessed_reviews(r, b.stored(r), 5000).select("review_id", "place_id", "rating")


@query
def place_top_reviews(spark, sf_dir):
    """Places of some brands have processed reviews, the others show raw ones."""
    scored = b.processed(spark, sf_dir).drop("review_date", "model_version")
    raw = scored.select("review_id", "place_id", "author_name", "rating")
    done = serving.lookup_many(scored, b.restaurants(spark, sf_dir).filter(F.col("rating") >= 3), "place_id")
    return serving.place_top_reviews(done, raw, 10)


# --- streams ---------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = b.table(spark, sf_dir, "events").schema
    return b.event_reviews(streaming.file_stream(spark, sf_dir, schema, pattern="events.parquet"))


@query
def stream_ingest(spark, sf_dir):
    path, checkpoint = new_work_path(spark, "stream-out"), new_work_path(spark, "stream-state")
    streaming.ingest_reviews(
        _event_stream(spark, sf_dir), path, checkpoint, as_of=F.lit(AS_OF).cast("date")
    ).awaitTermination()
    return streaming.read_stream_table(spark, path, "review_id").select(
        "review_id", "place_id", "author_name", "rating", "text_cleaned", "review_length", "word_count", "review_age_days"
    )


@query
def stream_counts(spark, sf_dir):
    table, checkpoint = new_work_path(spark, "stream-counts"), new_work_path(spark, "stream-state")
    counts = streaming.windowed_counts(_event_stream(spark, sf_dir), "place_id")
    streaming.append_batches(counts, table, checkpoint).awaitTermination()
    out = streaming.read_stream_table(spark, table, "window_key")
    return out.select(day("window_start").alias("window_day"), "place_id", "review_count")
