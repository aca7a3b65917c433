"""Scores kept up to date by batch, and places within reach found by cells, against their plain forms."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from platewise.config import RankingParams
from platewise.functions import geo
from platewise.operators import analysis, recommend
from platewise.plans import ingestion

LABELS = ["very_negative", "negative", "neutral", "positive", "very_positive", None]


def _reviews(spark, n, seed):
    rng = random.Random(seed)
    first = date(2020, 1, 1)
    rows = [
        (
            f"p{min(rng.randrange(12), rng.randrange(12))}",
            rng.choice(LABELS),
            None if rng.random() < 0.1 else rng.randrange(100, 501) / 100,
            rng.randrange(3000, 10000) / 10000,
            None if rng.random() < 0.1 else first + timedelta(days=rng.randrange(1500)),
        )
        for _ in range(n)
    ]
    typed = "place_id string, sentiment_label string, predicted_score double, confidence double, review_date date"
    return spark.createDataFrame(rows, typed).withColumns(
        {"predicted_score": F.col("predicted_score").cast("decimal(4,3)"), "confidence": F.col("confidence").cast("decimal(5,4)")}
    )


def _full(df, day):
    return analysis.place_scores(df.withColumn("review_age_days", F.datediff(F.lit(day).cast("date"), "review_date")))


def _unrounded(sums, day):
    """The recency mean itself, so that 1e-9 can be asked for."""
    return {
        r.place_id: (r.w / max(r.v, 1e-8), r.n)
        for r in analysis.add_decayed(sums, sums.limit(0), day)
        .groupBy("place_id")
        .agg(F.sum("weighted_sum").alias("w"), F.sum("weight_sum").alias("v"), F.sum("n").alias("n"))
        .collect()
    }


def test_decayed_sums_of_any_split_equal_the_full_pass(spark):
    everything = _reviews(spark, 600, 1).withColumn("part", F.pmod(F.hash("confidence", "review_date"), F.lit(3))).cache()
    last = "2024-06-01"
    whole = analysis.decayed_sums(everything, last)
    sums = analysis.decayed_sums(everything.filter("part = 0"), "2021-01-01")
    sums = analysis.add_decayed(sums, analysis.decayed_sums(everything.filter("part = 1"), "2022-03-04"), "2023-01-01")
    sums = analysis.add_decayed(sums, analysis.decayed_sums(everything.filter("part = 2"), "2020-02-29"), "2022-01-01")
    expected, found = _unrounded(whole, last), _unrounded(sums, last)
    assert expected.keys() == found.keys() and len(expected) == 12
    for place, (mean, n) in expected.items():
        assert found[place][1] == n and math.isclose(found[place][0], mean, rel_tol=1e-9)
    full = sorted(map(str, _full(everything, last).collect()))
    assert sorted(map(str, analysis.scores_of_sums(sums, last).collect())) == full
    assert sorted(map(str, analysis.scores_of_sums(whole, last).collect())) == full


def test_removed_and_empty_batches(spark, tmp_path):
    kept, gone = _reviews(spark, 200, 2), _reviews(spark, 100, 3)
    path = str(tmp_path / "sums")
    with pytest.raises(ValueError):
        ingestion.refresh_scores_by_batch(kept, path, "2024-01-01", removed=gone)
    ingestion.refresh_scores_by_batch(kept.unionByName(gone), path, "2024-01-01")
    ingestion.refresh_scores_by_batch(kept.limit(0), path, "2024-02-01", removed=gone)
    found = ingestion.refresh_scores_by_batch(kept.limit(0), path, "2024-03-01")
    assert sorted(map(str, found.collect())) == sorted(map(str, _full(kept, "2024-03-01").collect()))
    assert ingestion.refresh_scores_by_batch(kept.limit(0), str(tmp_path / "none"), "2024-03-01").count() == 0
    left = ingestion.refresh_scores_by_batch(kept.limit(0), path, "2024-03-01", removed=kept)
    assert left.count() == 0


def test_refresh_reads_sums_and_batch_only(spark, tmp_path):
    stored, batch = _reviews(spark, 100, 4), _reviews(spark, 20, 5)
    for name, df in (("facts", stored), ("batch", batch)):
        df.write.parquet(str(tmp_path / name))
    facts, added = (spark.read.parquet(str(tmp_path / n)) for n in ("facts", "batch"))
    path = str(tmp_path / "sums")
    ingestion.refresh_scores_by_batch(facts, path, "2024-01-01")
    found = ingestion.refresh_scores_by_batch(added, path, "2024-02-01")
    assert not any("facts" in f for f in found.inputFiles())
    assert sorted(map(str, found.collect())) == sorted(map(str, _full(facts.unionByName(added), "2024-02-01").collect()))


def _points(rng, n):
    special = [(90.0, 0.0), (-90.0, 50.0), (0.0, 180.0), (0.0, -180.0), (89.999, 12.0), (0.0, 0.0), (45.0, 179.9999), (-33.0, -179.9999)]
    return special + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)] + [
        (rng.uniform(33, 33.3), rng.uniform(-112.3, -112)) for _ in range(n)
    ]


def test_cells_hold_every_point_within_the_distance(spark):
    rng = random.Random(7)
    places = spark.createDataFrame([(i, *p) for i, p in enumerate(_points(rng, 150))], "p int, lat double, lng double")
    reach = [0.0, 0.5, 1.0, 4.0, 7.3, 64.0, 900.0, 9000.0, 12000.0, 20038.0, 1e9]
    users = [(i, *p, rng.choice(reach)) for i, p in enumerate(_points(rng, 60))]
    users = spark.createDataFrame(users, "u int, ulat double, ulng double, km double")
    near = geo.distance_km(F.col("lat"), F.col("lng"), (F.col("ulat"), F.col("ulng"))) <= F.col("km")
    expected = users.crossJoin(places).filter(near).select("u", "p")
    at_users = users.withColumn("cell", F.explode(geo.cells_within(F.col("ulat"), F.col("ulng"), F.col("km"))))
    at_places = places.withColumn("cell", F.explode(geo.cells_of(F.col("lat"), F.col("lng"))))
    found = at_users.join(at_places, "cell").filter(near).select("u", "p")
    assert sorted(found.collect()) == sorted(expected.collect()) and expected.count() > 1000
    # a pair meets in one cell at most, and a distance in few cells
    assert found.count() == found.distinct().count()
    sizes = users.select(F.size(geo.cells_within(F.col("ulat"), F.col("ulng"), F.col("km"))).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 32


def test_points_that_are_unknown_have_no_cell(spark):
    odd = spark.createDataFrame([(None, 1.0, 5.0), (1.0, None, 5.0), (91.0, 0.0, 5.0), (1.0, 1.0, None), (1.0, 1.0, -1.0)], "a double, b double, km double")
    assert {tuple(r.c) for r in odd.select(geo.cells_within(F.col("a"), F.col("b"), F.col("km")).alias("c")).collect()} == {()}
    assert [len(r.c) for r in odd.select(geo.cells_of(F.col("a"), F.col("b")).alias("c")).collect()] == [0, 0, 0, 9, 9]


def _analyses(spark, n=300):
    rng = random.Random(9)
    rows = [
        (f"p{i:03}", f"Place {i}", rng.randrange(10, 50) / 10, rng.randrange(10, 50) / 10, rng.randrange(40), 0.5, {"neutral": 1}, ["bar"],
         rng.uniform(33, 33.5) if i % 11 else None, rng.uniform(-112.5, -112))
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "place_id string, restaurant_name string, recommendation_score double, avg_predicted_score double, review_count int, "
        "positive_ratio double, sentiment_distribution map<string,int>, types array<string>, latitude double, longitude double",
    )


def test_nearby_places_equal_the_filter_form(spark):
    rng = random.Random(10)
    analyses = _analyses(spark).cache()
    wishes = [(f"u{i}", [33 + rng.random() / 2, -112 - rng.random() / 2], rng.choice([0.0, 2.0, 10.0, 40.0, None]), rng.choice([None, 2.5])) for i in range(40)]
    wishes += [("nowhere", None, 5.0, None), ("half", [33.0, None], 5.0, None)]
    prefs = spark.createDataFrame(wishes, "user_id string, near array<double>, max_km double, min_rating double")
    found = recommend.recommend_nearby(analyses, prefs, RankingParams(min_reviews=5), n=4)
    pairs = prefs.crossJoin(analyses.filter("review_count >= 5")).filter(
        (geo.distance_km(F.col("latitude"), F.col("longitude"), (F.col("near")[0], F.col("near")[1])) <= F.col("max_km"))
        & (F.col("min_rating").isNull() | (F.col("avg_predicted_score") >= F.col("min_rating")))
    )
    lists = {}
    for r in pairs.select("user_id", "place_id", "recommendation_score").collect():
        lists.setdefault(r.user_id, []).append((-r.recommendation_score, r.place_id))
    expected = sorted((u, k + 1, p) for u, own in lists.items() for k, (_, p) in enumerate(sorted(own)[:4]))
    assert sorted(tuple(r) for r in found.select("user_id", "position", "place_id").collect()) == expected
    assert len(expected) > 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


def test_users_with_a_place_meet_the_cells_around_it_only(spark):
    analyses = _analyses(spark).cache()
    params = RankingParams(top_n=200)
    wishes = [("near", None, None, [33.2, -112.2], 12.0), ("any", None, None, None, 12.0), ("no_km", None, 3.0, [33.2, -112.2], None), ("typed", ["BAR"], None, [33.4, -112.1], 30.0)]
    prefs = spark.createDataFrame(wishes, "user_id string, cuisine_types array<string>, min_rating double, near array<double>, max_km double")
    found = recommend.recommend_for_users(analyses, prefs, params)
    ranked = recommend.rank_restaurants(analyses, params)
    away = geo.distance_km(F.col("latitude"), F.col("longitude"), (F.col("near")[0], F.col("near")[1]))
    tests = (F.col("near").isNull() | F.col("max_km").isNull() | (away <= F.col("max_km"))) & (
        F.col("min_rating").isNull() | (F.col("avg_predicted_score") >= F.col("min_rating"))
    )
    expected = prefs.crossJoin(ranked).filter(tests).select("user_id", "rank", "place_id")
    assert sorted(found.select("user_id", "rank", "place_id").collect()) == sorted(expected.collect())
    assert {r.user_id for r in found.collect()} == {w[0] for w in wishes}
    assert "_cell" not in found.columns


def test_nearby_pairs_do_not_leave_their_task(spark):
    rng = np.random.default_rng(3)
    at = lambda n: pa.array(rng.uniform(0, 0.2, n))
    users = pa.table({"user_id": [str(i) for i in range(400)], "_lat": at(400), "_lng": at(400), "max_km": pa.array(rng.uniform(1, 9, 400)), "_floor": pa.array([None if i % 3 else 2.5 for i in range(400)], pa.float64())})
    places = pa.table({"place_id": [str(i % 4000) for i in range(5000)], "recommendation_score": pa.array(rng.integers(0, 50, 5000) / 10), "avg_predicted_score": pa.array(rng.uniform(1, 5, 5000)), "latitude": at(5000), "longitude": at(5000)})
    row, column, ordered = recommend._first_in_reach(users, places, 3)
    assert len(row) == 1200
    found = {(u, p) for u, p in zip(row.tolist(), column.tolist())}
    ranked = ordered.to_pylist()
    assert [(-r["recommendation_score"], r["place_id"]) for r in ranked] == sorted((-r["recommendation_score"], r["place_id"]) for r in ranked)
    for u, user in enumerate(users.to_pylist()):
        fits = []
        for p, r in enumerate(ranked):
            a, b = math.radians(user["_lat"]), math.radians(r["latitude"])
            h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(r["longitude"] - user["_lng"]) / 2) ** 2
            near = 2 * 6371 * math.asin(math.sqrt(h)) <= user["max_km"]
            if near and (user["_floor"] is None or r["avg_predicted_score"] >= user["_floor"]):
                fits.append((u, p))
            if len(fits) == 3:
                break
        assert set(fits) <= found


def test_a_load_makes_its_reviews_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    columns = "review_id string, place_id string, author_name string, rating int, text_cleaned string, review_length int"
    kind = f"{columns}, word_count int, review_date date, review_age_days int, loaded_at string"
    places = spark.createDataFrame([("p", "n", 1)], "place_id string, name string, total_ratings int")
    scores = spark.createDataFrame(
        [("a", "p", 4.0), ("c", "p", 2.0), ("x", "p", 1.0)], "review_id string, place_id string, predicted_score double"
    )

    def batch(*rows):
        filled = [(k, "p", "w", rating, None, 1, 1, date.fromisoformat(day), 1, at) for k, rating, day, at in rows]
        return spark.createDataFrame(filled, kind).mapInArrow(counted, kind)

    path = str(tmp_path / "warehouse")
    first = batch(("a", 1, "2020-01-01", "1"), ("b", 2, "2020-01-02", "1"), ("b", 3, "2020-01-05", "1"), (None, 4, "2020-01-09", "1"))
    ingestion.load_warehouse(path, places, first, scores)
    assert made.value == 4 and first.storageLevel == StorageLevel.NONE
    later = batch(("a", 5, "2020-02-01", "2"), ("c", 3, "2020-01-02", "2"))
    with ingestion.held_on_disk(later):
        tables = ingestion.load_warehouse(path, places, later, scores)
        assert made.value == 6 and later.storageLevel != StorageLevel.NONE
    assert later.storageLevel == StorageLevel.NONE
    facts = {(r.review_id, float(r.rating), r.review_date.isoformat(), r.loaded_at) for r in tables["fact_reviews"].collect()}
    assert facts == {
        ("a", 5.0, "2020-01-01", "2"),
        ("b", 2.0, "2020-01-02", "1"),
        ("c", 3.0, "2020-01-02", "2"),
        (None, 4.0, "2020-01-09", "1"),
    }
    # also the days of copies and of later news of a known review
    days = {r.full_date.isoformat() for r in tables["dim_time"].collect()}
    assert days == {"2020-01-01", "2020-01-02", "2020-01-05", "2020-01-09", "2020-02-01"}
    found = {(r.review_id, float(r.predicted_score)) for r in tables["fact_predictions"].collect()}
    assert found == {("a", 4.0), ("c", 2.0)}
