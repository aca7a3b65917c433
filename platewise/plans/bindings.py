"""The given tables seen as reviews, places, predictions and texts.

``FIXTURES.md`` describes the mapping; ``oracle.py`` states the same in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.operators.dedup import top_per_key

# two days that part the reviews into what is stored already and what arrives
STORED_BEFORE = "2000-01-01"
ARRIVED_SINCE = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), key).alias("place_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("address"),
        (33 + (key % 100) / 100.0).cast("decimal(10,7)").alias("latitude"),
        (-112 + (key % 70) / 100.0).cast("decimal(10,7)").alias("longitude"),
        (1 + (key * 37 % 401) / 100.0).cast("decimal(3,2)").alias("rating"),
        (size * 10).alias("total_ratings"),
        F.when(size % 10 == 0, None).otherwise(1 + size % 4).alias("price_level"),
        F.split(F.concat(F.lower("p_type"), F.lit(" "), F.col("p_name")), " ").alias("types"),
    )


def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What tells the copies of a review apart; the rating follows from ``q``."""
    copies = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("place_id"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("author_name"),
        F.col("l_shipdate").alias("review_date"),
        F.round(F.col("l_discount") * 100).cast("int").alias("d"),
        F.round(F.col("l_tax") * 100).cast("int").alias("t"),
        F.col("l_extendedprice").alias("ep"),
        F.col("l_quantity").alias("q"),
    )
    return copies


def _with_rating(df: DataFrame) -> DataFrame:
    return df.withColumn("rating", 1 + F.col("q").cast("int") % 5)


def reviews_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as reviews; a review id occurs more than once."""
    return _with_rating(_copies(spark, sf_dir))


COPY_ORDER = ["place_id", "author_name", "ep", "q", "d", "t"]


def latest_first():
    return [F.desc("review_date"), *map(F.col, COPY_ORDER)]


def reviews(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """One row per review: the latest copy.

    ``since`` may filter before the dedupe, down at the scan, because the copy that is
    kept is the latest one: it passes whenever any copy passes. Derived columns come
    after the dedupe, so a query that uses reviews and predictions shuffles once.
    """
    copies = _copies(spark, sf_dir)
    if since is not None:
        copies = copies.filter(F.col("review_date") >= F.lit(since))
    return _with_rating(top_per_key(copies, ["review_id"], latest_first())).drop("ep", "q")


def as_of(spark: SparkSession, sf_dir: str) -> date:
    """Day of the latest review, the reference day of ages and trailing windows."""
    row = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("m")).first()
    return row["m"].date()


def with_prediction(df: DataFrame) -> DataFrame:
    d = F.col("d")
    return df.withColumns(
        {
            "predicted_score": (F.lit(1) + d * F.lit(0.4)).cast("decimal(3,2)"),
            "sentiment_label": F.when(d <= 1, "very_negative")
            .when(d <= 3, "negative")
            .when(d <= 6, "neutral")
            .when(d <= 8, "positive")
            .otherwise("very_positive"),
            "confidence": (F.lit(0.30) + F.col("t") * F.lit(0.08)).cast("decimal(5,4)"),
            "model_version": F.lit("bound-v1"),
        }
    )


PREDICTION_COLUMNS = [
    "review_id",
    "place_id",
    "predicted_score",
    "sentiment_label",
    "confidence",
    "model_version",
]


def predictions(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    return with_prediction(reviews(spark, sf_dir, since)).select(*PREDICTION_COLUMNS)


def processed(spark: SparkSession, sf_dir: str, today: date | None = None) -> DataFrame:
    """Reviews with their prediction and, for a given day, their age."""
    out = with_prediction(reviews(spark, sf_dir))
    if today is not None:
        out = out.withColumn("review_age_days", F.datediff(F.lit(today), F.to_date("review_date")))
    return out.drop("d", "t")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the raw review schema, with markup, odd ratings and copies."""
    q = F.col("l_quantity").cast("int")
    seconds = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    epoch = seconds + F.col("l_linenumber") * 3600
    author = F.concat(F.lit("S"), F.col("l_suppkey"))
    raw = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("place_id"),
        F.concat(F.lit("Place "), F.col("l_partkey")).alias("restaurant_name"),
        author.alias("author_name"),
        F.when(q % 13 == 0, None).otherwise((q % 7).cast("double")).alias("rating"),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("<p>Great <b>food</b>!</p>  by "), author))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("  Slow\t service<br>from "), author, F.lit("\n")))
        .when(q % 4 == 0, F.lit(" <i>ok</i> "))
        .otherwise(F.concat(F.lit("a<b>b</b>c  fine for "), F.col("l_extendedprice").cast("int")))
        .alias("text"),
        F.lit("en").alias("language"),
        epoch.alias("time_epoch"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00+00:00")).alias("review_time"),
        F.lit("").alias("relative_time"),
        F.lit("").alias("profile_photo_url"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ingested_at"),
    )
    return raw


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as review texts, with markup, links, contractions and key words.

    Every fifth document has a second review, with an id of its own, that is blank.
    """
    body, kind = F.col("text"), F.col("doc_id") % 5
    documents = table(spark, sf_dir, "documents")
    written = F.concat(F.lit("D"), F.col("doc_id"))
    review = (
        F.when(kind == 0, F.concat(F.lit("<p>The pizza</p> isn't bad & the staff's great! "), body))
        .when(kind == 1, F.concat(F.lit("  see https://ex.example/a?b=1 for the price  "), body))
        .when(kind == 2, F.concat(F.lit("We won't return, it's slow<br>service "), body))
        .otherwise(body)
    )

    def rows(docs: DataFrame, doc_id: Column, review_id: Column, content: Column) -> DataFrame:
        return docs.select(
            doc_id.alias("doc_id"),
            review_id.alias("review_id"),
            F.col("source").alias("place_id"),
            F.col("lang").alias("language"),
            content.alias("text"),
            F.concat(F.lit("Source "), F.col("source")).alias("restaurant_name"),
            (F.col("doc_id") % 7).cast("double").alias("rating"),
            (F.lit(1_600_000_000) + F.col("doc_id") * 7200).alias("time_epoch"),
            F.lit("2024-01-01").alias("ingested_at"),
        )

    blank = F.concat(F.lit("E"), F.col("doc_id"))
    return rows(documents, F.col("doc_id"), written, review).unionByName(
        rows(documents.filter(kind == 4), -1 - F.col("doc_id"), blank, F.lit("  <i></i> "))
    )


def text_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star ratings of the labelled documents, from quality and toxicity."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", (F.lit(3.0) + 2 * F.col("quality") - 2 * F.col("toxic")).alias("rating")
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector folded to five class logits of a document: number i counts for class i modulo 5."""
    numbers = F.col("embedding").cast("array<double>")

    def folded(k: int) -> Column:
        return F.aggregate(F.filter(numbers, lambda x, i: i % 5 == k), F.lit(0.0), lambda a, x: a + x)

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.when(numbers.isNotNull(), F.array(*[folded(k) for k in range(5)])).alias("logits"),
    )


def stored(df: DataFrame) -> DataFrame:
    return df.filter(F.col("review_date") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))


def arrived(df: DataFrame) -> DataFrame:
    return df.filter(F.col("review_date") >= F.lit(ARRIVED_SINCE).cast("timestamp_ntz"))


def event_reviews(events: DataFrame) -> DataFrame:
    """Events as short reviews; works for a batch and for a stream."""
    return events.select(
        F.col("event_id").cast("string").alias("review_id"),
        F.col("event_type").alias("place_id"),
        F.concat(F.lit("U"), F.col("user_id")).alias("author_name"),
        (F.floor("value") % 7).cast("double").alias("rating"),
        F.concat(F.lit("<b>"), F.col("event_type"), F.lit("</b>  says "), F.col("props")).alias("text"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("time_epoch"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def user_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users; a list may be absent (null) or empty."""
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey")).alias("user_id"),
        F.when(segment == "MACHINERY", F.array(F.lit("gear"), F.lit("BOLT")))
        .when(segment == "BUILDING", F.array(F.lit("Plate"), F.lit("small")))
        .when(segment == "FURNITURE", F.array().cast("array<string>"))
        .when(segment == "AUTOMOBILE", F.array(F.lit("Widget"), F.lit("promo")))
        .alias("cuisine_types"),
        F.when(F.col("c_acctbal") >= 0, (F.col("c_nationkey") % 5 * 0.1 + 2.8).cast("decimal(3,2)").cast("double")).alias(
            "min_rating"
        ),
        "c_nationkey",
    )
