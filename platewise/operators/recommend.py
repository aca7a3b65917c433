"""Ranking, recommendations and their preference filters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from platewise.config import Preferences, RankingParams
from platewise.functions.geo import EARTH_KM, FARTHEST_KM, cells_of, cells_within, distance_km
from platewise.operators.dedup import top_per_key
from platewise.session import new_work_path

RECOMMENDATION_COLUMNS = [
    "rank",
    "place_id",
    "restaurant_name",
    "recommendation_score",
    "avg_predicted_score",
    "review_count",
    "positive_ratio",
    "sentiment_distribution",
]


def numbered(df: DataFrame, order_by: list[Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows with their position.

    The limit is taken per task first, so only ``n`` rows reach the one task that numbers.
    """
    top = df.orderBy(*order_by).limit(n)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order_by)))


def rank_restaurants(analyses: DataFrame, params: RankingParams = RankingParams()) -> DataFrame:
    """The best places with enough reviews; ties of the rounded score go by place id."""
    eligible = analyses.filter(F.col("review_count") >= params.min_reviews)
    return numbered(eligible, [F.desc("recommendation_score"), F.col("place_id")], params.top_n)


def _any_type_equals(wanted) -> Column:
    lowered = F.transform(F.coalesce("types", F.array().cast("array<string>")), F.lower)
    return F.arrays_overlap(lowered, F.array(*[F.lit(w.lower()) for w in wanted]).cast("array<string>"))


def apply_preferences(ranked: DataFrame, prefs: Preferences) -> DataFrame:
    """Keep ranked places a user would accept; ranks stay global and may have gaps."""
    out = ranked
    if prefs.min_rating is not None:
        out = out.filter(F.col("avg_predicted_score") >= prefs.min_rating)
    if prefs.cuisine_types is not None:
        out = out.filter(_any_type_equals(prefs.cuisine_types))
    if prefs.price_range is not None:
        out = out.filter(F.col("price_level").between(*prefs.price_range))
    if prefs.near is not None and prefs.max_km is not None:
        out = out.filter(distance_km(F.col("latitude"), F.col("longitude"), prefs.near) <= prefs.max_km)
    return out


def recommend(
    analyses: DataFrame, prefs: Preferences | None = None, params: RankingParams = RankingParams()
) -> DataFrame:
    """Recommendations for everybody, or for one user's preferences.

    The cut to ``top_n`` comes before the preferences.
    """
    ranked = rank_restaurants(analyses, params)
    if prefs is not None:
        ranked = apply_preferences(ranked, prefs)
    return ranked.select(*RECOMMENDATION_COLUMNS).withColumnRenamed(
        "sentiment_distribution", "sentiment_summary"
    )


ANY_TYPE = "*"
#: the cell every place has, for users who look anywhere
ANYWHERE = -1


def recommend_for_users(
    analyses: DataFrame, preferences: DataFrame, params: RankingParams = RankingParams()
) -> DataFrame:
    """Recommendations of every user with stored preferences, in one equi-join.

    ``preferences`` holds user_id, cuisine_types and min_rating, and may hold price_range
    (lowest and highest level), near (latitude and longitude) and max_km, which need the
    places' price and coordinates. A null list accepts any type (matched through one extra
    type every place has); an empty list accepts none. Other nulls are no filter.
    Users with a place to be near to meet the ranked places of the cells around it only, by
    the same join; the distance itself is tested on these. Whether the ranked places are
    broadcast is left to Spark's check of their size.

    The ranked places are stored first, so they are found once. Users are dealt to tasks
    before the join multiplies them, and until a list is free of copies it holds ranks only.
    """
    spark = preferences.sparkSession
    path = new_work_path(spark, "ranked")
    found = rank_restaurants(analyses, params)
    found.write.parquet(path)
    ranked = spark.read.schema(found.schema).parquet(path)
    lowered = F.transform(F.coalesce("types", F.array().cast("array<string>")), F.lower)
    tests = {
        "price_range": ("price_level",),
        "near": ("latitude", "longitude"),
    }
    facts = [c for wish, needed in tests.items() if wish in preferences.columns for c in needed]
    by_type = ranked.select(
        "rank",
        "avg_predicted_score",
        *facts,
        F.explode(F.array_distinct(F.concat(lowered, F.array(F.lit(ANY_TYPE))))).alias("type"),
    )
    wanted = F.coalesce(F.transform("cuisine_types", F.lower), F.array(F.lit(ANY_TYPE)))
    wishes = [c for c in ("price_range", "near", "max_km") if c in preferences.columns]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    users = preferences.select("user_id", "cuisine_types", "min_rating", *wishes).repartition(parts, "user_id")
    users = users.select("user_id", "min_rating", *wishes, F.explode(F.array_distinct(wanted)).alias("type"))
    keys = ["type"]
    if "near" in wishes:
        keys = ["type", "_cell"]
        by_type = by_type.withColumn("_cell", F.explode(_place_cells()))
        users = users.withColumn("_cell", F.explode(_user_cells()))
    hits = users.join(by_type, keys).filter(
        F.col("min_rating").isNull() | (F.col("avg_predicted_score") >= F.col("min_rating"))
    )
    if "price_range" in wishes:
        low, high = F.col("price_range")[0], F.col("price_range")[1]
        hits = hits.filter(F.col("price_range").isNull() | F.col("price_level").between(low, high))
    if "near" in wishes:
        hits = hits.filter(_in_reach())
    whole = ranked.select(*RECOMMENDATION_COLUMNS).withColumnRenamed("sentiment_distribution", "sentiment_summary")
    listed = hits.select("user_id", "rank").distinct().join(whole, "rank")
    return listed.select("user_id", *whole.columns)


def _place_cells() -> Column:
    cells = cells_of(F.col("latitude"), F.col("longitude"))
    return F.concat(cells, F.array(F.lit(ANYWHERE).cast("bigint")))


def _user_cells() -> Column:
    anywhere = F.col("near").isNull() | F.col("max_km").isNull()
    cells = cells_within(F.col("near")[0], F.col("near")[1], F.col("max_km"))
    return F.when(anywhere, F.array(F.lit(ANYWHERE).cast("bigint"))).otherwise(cells)


def _in_reach() -> Column:
    away = distance_km(F.col("latitude"), F.col("longitude"), (F.col("near")[0], F.col("near")[1]))
    return F.col("near").isNull() | F.col("max_km").isNull() | (away <= F.col("max_km"))


def recommend_nearby(
    analyses: DataFrame, preferences: DataFrame, params: RankingParams = RankingParams(), n: int = 10
) -> DataFrame:
    """The best ``n`` places within reach of each user, of all places with enough reviews.

    Unlike the other lists this one isn't cut to the places that are best anywhere, so a
    user far from these has a list too. ``preferences`` holds user_id, near and max_km, and
    may hold min_rating; users without near or max_km are in no list, they have the global
    one. Users meet the places around them by cell, in blocks of bounded size; a task walks
    down the places, best first, and passes on the first ``n`` of each user. No other pair
    leaves a task. Ties of the rounded score go by place id.
    """
    spark = preferences.sparkSession
    path = new_work_path(spark, "eligible")
    shown = ["place_id", "restaurant_name", "recommendation_score", "avg_predicted_score", "review_count"]
    eligible = analyses.filter(F.col("review_count") >= params.min_reviews).select(
        *shown, F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude")
    )
    eligible.write.parquet(path)
    places = spark.read.schema(eligible.schema).parquet(path)
    places = places.withColumn("_cell", F.explode(cells_of(F.col("latitude"), F.col("longitude"))))
    floor = F.col("min_rating") if "min_rating" in preferences.columns else F.lit(None)
    users = preferences.filter(F.col("near").isNotNull() & F.col("max_km").isNotNull())
    users = users.withColumn("_cell", F.explode(_user_cells())).select(
        "user_id",
        F.col("near")[0].cast("double").alias("_lat"),
        F.col("near")[1].cast("double").alias("_lng"),
        F.col("max_km").cast("double").alias("max_km"),
        floor.cast("double").alias("_floor"),
        "_cell",
    )

    def blocks(df: DataFrame, at_once: int, name: str) -> DataFrame:
        return df.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / at_once).cast("int").alias(name))

    # a cell with very many users or places is cut into blocks, each pair of which is a task's group
    sizes = blocks(users, USERS_AT_ONCE, "_users").join(blocks(places, PLACES_AT_ONCE, "_places"), "_cell")

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        block = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
        rows = df.join(sizes, "_cell").select(*df.columns, block.alias("_block"), every.alias("_every"))
        return rows.withColumnsRenamed({"_block": own, "_every": other})

    groups = ["_cell", "_users", "_places"]
    left, right = dealt(users, "user_id", "_users", "_places"), dealt(places, "place_id", "_places", "_users")
    sent = ["user_id", "_lat", "_lng", "max_km"], [*shown, "latitude", "longitude"]
    schema = StructType([users.schema[c] for c in sent[0]] + [places.schema[c] for c in sent[1]])

    def first(of_users: pa.Table, of_places: pa.Table) -> pa.Table:
        row, column, of_places = _first_in_reach(of_users, of_places, n)
        found = [of_users[c].take(row) for c in sent[0]] + [of_places[c].take(column) for c in sent[1]]
        return pa.table(found, names=[*sent[0], *sent[1]])

    near = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInArrow(first, schema)
    away = distance_km(F.col("latitude"), F.col("longitude"), (F.col("_lat"), F.col("_lng")))
    hits = near.filter(away <= F.col("max_km")).select("user_id", *shown)
    order = [F.desc("recommendation_score"), F.col("place_id")]
    best = top_per_key(hits, ["user_id"], order, n)
    position = F.row_number().over(Window.partitionBy("user_id").orderBy(*order))
    return best.withColumn("position", position)


USERS_AT_ONCE = 65_536
PLACES_AT_ONCE = 262_144


def _on_globe(lat: np.ndarray, lng: np.ndarray) -> np.ndarray:
    lat, lng = np.radians(lat), np.radians(lng)
    return np.stack([np.cos(lat) * np.cos(lng), np.cos(lat) * np.sin(lng), np.sin(lat)], axis=1)


def _first_in_reach(users: pa.Table, places: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Users (row) with the first ``n`` places (column) within their reach, and the places in their order.

    A few users that are near each other walk down the places around them, best first,
    until each has ``n``. Places whose distance is that of the reach, up to rounding, are
    passed on as well and not counted, so that the caller's own test decides on them.
    """
    rows, columns = [np.array([], int)], [np.array([], int)]
    if users.num_rows and places.num_rows:
        keys = places.select(["place_id", "recommendation_score"]).append_column("known", places["place_id"].is_valid())
        order = [("recommendation_score", "descending"), ("known", "ascending"), ("place_id", "ascending")]
        places = places.take(pc.sort_indices(keys, sort_keys=order))
        at = _on_globe(places["latitude"].to_numpy(), places["longitude"].to_numpy())
        score = places["avg_predicted_score"].cast(pa.float64()).to_numpy()
        lat, lng, reach = (users[c].to_numpy() for c in ("_lat", "_lng", "max_km"))
        floor = users["_floor"].to_numpy()
        # a null is no filter
        floor = np.where(np.isnan(floor), -np.inf, floor)
        score = np.where(np.isnan(score), -np.inf, score)
        own = _on_globe(lat, lng)
        reach = np.minimum(reach, FARTHEST_KM) / EARTH_KM
        sure, maybe = ((2 * np.sin(np.clip(reach + e, 0, np.pi) / 2)) ** 2 for e in (-1e-9, 1e-9))
        sure = np.where(reach < 1e-9, -1.0, sure)
        scale = np.floor(np.log2(np.maximum(reach, 1e-6)))
        width = np.exp2(scale - 2)
        close = np.lexsort((np.floor(np.radians(lng) / width), np.floor(np.radians(lat) / width), scale))
        for start in range(0, len(close), 256):
            some = close[start : start + 256]
            centre = own[some].mean(axis=0)
            centre /= max(np.linalg.norm(centre), 1e-12)
            spread = np.arccos(np.clip(own[some] @ centre, -1, 1)).max() + reach[some].max() + 1e-6
            around = np.flatnonzero(at @ centre >= np.cos(min(spread, np.pi)) - 1e-12)
            have, begin, step = np.zeros(len(some), int), 0, 512
            while begin < len(around) and len(some):
                part = around[begin : begin + step]
                begin, step = begin + step, min(step * 2, 8192)
                square = sum((own[some, k : k + 1] - at[part, k]) ** 2 for k in range(3))
                hit = (square <= maybe[some, None]) & ((score[part] >= floor[some, None]) & (score[part] > -np.inf) | np.isneginf(floor[some, None]))
                counted = hit & (square <= sure[some, None])
                before = np.cumsum(counted, axis=1) - counted + have[:, None]
                row, column = np.nonzero(hit & (before < n))
                rows.append(some[row])
                columns.append(part[column])
                have = have + counted.sum(axis=1)
                some, have = some[have < n], have[have < n]
    return np.concatenate(rows), np.concatenate(columns), places


def recommendation_docs(recommendations: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """One document per user with the ranked list; a list has at most ``top_n`` entries."""
    fields = [c for c in recommendations.columns if c not in ("user_id", "sentiment_summary")]
    fields = ["rank", *[c for c in fields if c != "rank"]]
    if "sentiment_summary" in recommendations.columns:
        # maps cannot be compared while sorting the list, entry arrays can
        recommendations = recommendations.withColumn("_summary", F.map_entries("sentiment_summary"))
        entry = F.struct(*fields, "_summary")
    else:
        entry = F.struct(*fields)
    docs = recommendations.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("recommendations"))
    if "sentiment_summary" in recommendations.columns:
        docs = docs.withColumn(
            "recommendations",
            F.transform(
                "recommendations",
                lambda r: F.struct(
                    *[r[f].alias(f) for f in fields],
                    F.map_from_entries(r["_summary"]).alias("sentiment_summary"),
                ),
            ),
        )
    return docs.withColumn("generated_at", F.current_timestamp() if generated_at is None else generated_at)
