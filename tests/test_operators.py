import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from platewise.config import Preferences, RankingParams
from platewise.functions import sentiment
from platewise.operators import analysis, bi, cleaning, collaborative, dedup, merge, recommend, scoring, serving, star, stats


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns[:1])).collect()]


RAW = "review_id string, place_id string, restaurant_name string, author_name string, rating double, text string, time_epoch bigint, ingested_at string"


def raw(spark, data):
    return spark.createDataFrame(data, RAW)


def test_dedup_keeps_latest(spark):
    df = raw(
        spark,
        [
            ("a", "p", "P", "x", 1.0, "old text", 0, "2024-01-01"),
            ("a", "p", "P", "x", 2.0, "new text", 0, "2024-01-02"),
            ("a", "p", "P", "x", 3.0, "no date", 0, None),
            (None, "p", "P", "x", 1.0, "t", 0, "2024-01-01"),
            (None, "p", "P", "x", 1.0, "t", 0, "2024-01-01"),
        ],
    )
    assert rows(dedup.dedup_reviews(df).select("review_id", "rating")) == [(None, 1.0), ("a", 2.0)]


def test_clean_and_features(spark):
    df = raw(
        spark,
        [
            ("a", "p", "P", "x", 7.0, "<p>Great food</p>", 86400, "d"),
            ("b", "p", "P", "x", 0.5, " <i>12345</i>", 0, "d"),
            ("c", "p", "P", "x", None, "fine place", 0, "d"),
            ("d", "p", "P", "x", 3.0, None, 0, "d"),
        ],
    )
    out = cleaning.engineer_features(cleaning.clean_reviews(df), "1970-01-11")
    got = out.select("review_id", "rating", "text_cleaned", "review_length", "word_count", "has_text", "day_of_week", "review_age_days")
    assert rows(got) == [
        ("a", 5.0, "Great food", 10, 2, True, 6, 9),
        ("c", None, "fine place", 10, 2, True, 5, 10),
    ]
    job = cleaning.engineer_features(cleaning.clean_reviews(df, "job"), mode="job")
    assert rows(job.select("review_id", "rating", "rating_category", "review_year", "review_month")) == [
        ("a", 7.0, "positive", 1970, 1),
        ("c", None, "neutral", 1970, 1),
    ]
    assert rows(cleaning.clean_counts(df)) == [(4, 2, 2)]


FEATURED = "place_id string, restaurant_name string, rating double, review_length int, word_count int, review_date timestamp"


def test_stats_of_single_review(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("p", "P", 5.0, 10, 2, day)], FEATURED)
    r = stats.restaurant_stats(df).first()
    assert (r.review_count, r.rating_stddev, r.five_star_count, r.one_star_count, r.positive_ratio) == (1, 0.0, 1, 0, 1.0)
    j = stats.restaurant_stats_job(df).first()
    assert (j.rating_stddev, j.positive_reviews, j.negative_reviews, j.positive_ratio) == (None, 1, 0, 1.0)


def test_star_dim_time_has_one_row_per_day(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 12, 29, 1),), (dt.datetime(2024, 12, 29, 9),), (dt.datetime(2024, 12, 30, 1),)],
        "review_date timestamp",
    )
    assert rows(star.dim_time(df)) == [
        (dt.date(2024, 12, 29), 2024, 12, 29, 4, 1, 52),
        (dt.date(2024, 12, 30), 2024, 12, 30, 4, 2, 1),
    ]


TARGET = "k string, a string, b int"


@pytest.mark.parametrize("small", [False, True])
def test_merge(spark, small):
    target = spark.createDataFrame([("1", "x", 1), ("2", "y", 2), ("3", "z", 3)], TARGET)
    updates = spark.createDataFrame([("2", None, 20), ("3", "z", 3), ("4", "n", 4)], TARGET)
    kept = merge.merge_by_key(target, updates, "k", keep_if_null=True, op_col="op", small_updates=small)
    assert rows(kept) == [
        ("1", "x", 1, "kept"),
        ("2", "y", 20, "modified"),
        ("3", "z", 3, "unchanged"),
        ("4", "n", 4, "inserted"),
    ]
    assert rows(merge.merge_counts(kept, "op")) == [(1, 1)]
    replaced = merge.merge_by_key(target, updates, "k", ["a"], small_updates=small)
    assert rows(replaced) == [("1", "x", 1), ("2", None, 2), ("3", "z", 3), ("4", "n", 4)]


def test_merge_is_idempotent_and_last_one_wins(spark):
    target = spark.createDataFrame([("1", "x", 1)], TARGET)
    updates = spark.createDataFrame([("1", "first", 1), ("1", "last", 2), ("9", None, 9)], TARGET)
    order = [F.desc("b")]
    once = merge.merge_by_key(target, updates, "k", order_by=order)
    assert rows(once) == [("1", "last", 2), ("9", None, 9)]
    twice = merge.merge_by_key(once, updates, "k", order_by=order, op_col="op")
    assert {r.op for r in twice.collect()} == {"unchanged"}


def test_merge_with_absent_and_new_columns(spark):
    target = spark.createDataFrame([("1", "x", 1)], TARGET)
    updates = spark.createDataFrame([("1", "new"), ("2", "more")], "k string, c string")
    assert rows(merge.merge_by_key(target, updates, "k")) == [("1", "x", 1, "new"), ("2", None, None, "more")]


def test_merge_of_empty_batch(spark):
    target = spark.createDataFrame([("1", "x", 1)], TARGET)
    merged = merge.merge_by_key(target, target.limit(0), "k", op_col="op")
    assert rows(merged) == [("1", "x", 1, "kept")]
    assert rows(merge.merge_counts(merged, "op")) == [(0, 0)]


def test_warehouse_merges_respect_their_columns(spark):
    place = "place_id string, name string, address string, latitude double, longitude double, rating double, total_ratings int, price_level int, types string, updated_at string"
    known = spark.createDataFrame([("p", "old", "a", 1.0, 2.0, 3.0, 1, 1, "x", "t0")], place)
    new = spark.createDataFrame([("p", "new", "b", 9.0, 9.0, 4.0, 2, 2, "y", "t1")], place)
    assert rows(merge.merge_dim_restaurants(known, new)) == [("p", "new", "b", 1.0, 2.0, 4.0, 2, 2, "y", "t1")]

    fact = "review_id string, place_id string, rating double, review_text string, review_length int, review_age_days int, loaded_at string"
    known = spark.createDataFrame([("r", "p", 1.0, "t", 1, 5, "t0")], fact)
    new = spark.createDataFrame([("r", "q", 2.0, "cleaned", 9, 6, "t1"), ("s", "q", 2.0, None, 9, 6, "t1")], fact.replace("review_text", "text_cleaned"))
    assert rows(merge.merge_fact_reviews(known, new)) == [
        ("r", "p", 2.0, "cleaned", 1, 6, "t1"),
        ("s", "q", 2.0, "", 9, 6, "t1"),
    ]


def test_reference_split_is_a_partition(spark):
    preds = spark.createDataFrame([("a",), ("b",), (None,)], "review_id string")
    facts = spark.createDataFrame([("a",), ("c",)], "review_id string")
    ok, rejected = merge.split_by_reference(preds, facts, "review_id")
    assert rows(ok) == [("a",)] and rows(rejected) == [(None,), ("b",)]


def test_preferences_defaults(spark):
    schema = "user_id string, cuisine_types array<string>, min_rating double"
    known = spark.createDataFrame([("u", ["x"], 4.0)], schema)
    sent = spark.createDataFrame([("u", None, None), (None, ["y"], 2.0)], schema)
    assert rows(merge.upsert_preferences(known, sent, [F.col("min_rating")]).drop("updated_at", "price_range")) == [
        ("anonymous", ["y"], 2.0),
        ("u", [], 3.0),
    ]


def test_scores_from_logits(spark):
    df = spark.createDataFrame([([0.1, 0.1, 0.1, 0.2, 2.5],), ([0.0] * 5,), ([900.0, 0.0, 0.0, 0.0, 0.0],)], "logits array<double>")
    got = [tuple(r)[1:] for r in scoring.score_from_logits(df).collect()]
    assert got[0][:2] == (4.332, "very_positive")
    assert got[1] == (3.0, "very_negative", 0.2)
    assert got[2] == (1.0, "very_negative", 1.0)
    sums = df.select(F.aggregate(sentiment.softmax(F.col("logits")), F.lit(0.0), lambda x, y: x + y).alias("s"))
    assert all(math.isclose(r.s, 1.0) for r in sums.collect())


def _model(df, text_col):
    return df.withColumn("logits", F.array(*[F.lit(float(x)) for x in (0, 0, 0, 0, 9)]))


def test_score_reviews(spark):
    df = spark.createDataFrame([("a", "great pizza"), ("b", ""), ("c", None), ("d", "<i></i>")], "review_id string, text string")
    got = scoring.score_reviews(df, _model, "org/some-model", F.lit("now")).select(
        "review_id", "sentiment_label", "confidence", "text_cleaned", "model_version", "key_phrases"
    )
    first, *rest = rows(got)
    assert first[1] == "very_positive" and first[3:] == ("great pizza", "some-model", ["pizza"])
    assert [r[1:4] for r in rest] == [("neutral", 0.0, "")] * 3


def test_batch_model_skips_empty_texts(spark):
    def load():
        import numpy as np

        def predict(texts):
            assert all(texts) and len(texts) <= 2
            return np.array([[0, 0, 0, 0, len(t)] for t in texts], dtype=float)

        return predict

    df = spark.createDataFrame([(str(i), "x" * (i % 4)) for i in range(50)], "review_id string, text string")
    out = scoring.batch_model(load, batch_size=2)(df, "text")
    for r in out.collect():
        assert (r.logits is None) if r.text == "" else (r.logits[4] == len(r.text))


def test_ensure_scored(spark):
    df = spark.createDataFrame(
        [("a", "t", 2.0, "negative", None), ("b", "t", None, None, None)],
        "review_id string, text string, predicted_score double, sentiment string, confidence double",
    )
    got = scoring.ensure_scored(df, _model, "m", F.lit("now")).select("review_id", "predicted_score", "sentiment_label", "confidence")
    assert rows(got) == [("a", 2.0, "negative", 0.0), ("b", 4.999, "very_positive", 0.9995)]


def test_unscored_reviews_count_nowhere(spark):
    df = spark.createDataFrame([("p", 4.0, "positive", 0.5, 0), ("p", None, None, None, 0)], SCORED)
    got = analysis.place_scores(df).first()
    assert (got.review_count, got.avg_predicted_score, got.recency_weighted_score) == (1, 4.0, 4.0)
    assert got.bayesian_score == round(34 / 11, 3)


def test_copies_in_a_batch_do_not_multiply(spark):
    target = spark.createDataFrame([("a", 1.0)], "review_id string, predicted_score double")
    batch = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 3.0), ("b", 3.5)], target.schema)
    once = merge.upsert_processed(target, batch)
    assert rows(once) == [("a", 2.0), ("b", 3.0)]
    assert rows(merge.upsert_processed(once, batch)) == [("a", 2.0), ("b", 3.0)]


def test_batch_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "predicted_score double, confidence double")
    assert rows(scoring.batch_summary(empty)) == [(0, None, None)]


SCORED = "place_id string, predicted_score double, sentiment_label string, confidence double, review_age_days int"


def test_analysis(spark):
    scored = spark.createDataFrame(
        [("p", 5.0, "very_positive", 0.9, 0), ("p", 1.0, "very_negative", 0.7, 90), ("p", 4.0, "positive", 0.5, None)], SCORED
    )
    places = spark.createDataFrame([("p", "P", ["bar"]), ("q", None, None)], "place_id string, name string, types array<string>")
    got = {r.place_id: r for r in analysis.analyze_restaurants(scored, places, keep_empty=True).collect()}
    p = got["p"]
    weights = [1.0, math.exp(-0.693), math.exp(-0.693 * 30 / 90)]
    recency = (5 * weights[0] + 1 * weights[1] + 4 * weights[2]) / sum(weights)
    bayes = (30 + 10) / 13
    assert p.review_count == 3 and p.avg_predicted_score == 3.333 and p.avg_confidence == 0.7
    assert p.bayesian_score == round(bayes, 3) and p.recency_weighted_score == round(recency, 3)
    assert p.recommendation_score == round(0.5 * bayes + 0.3 * recency + 0.2 * 3 / 50 * 5, 3)
    assert p.positive_ratio == 0.667
    assert p.sentiment_distribution == {"positive": 1, "very_negative": 1, "very_positive": 1}
    q = got["q"]
    assert (q.review_count, q.bayesian_score, q.recommendation_score, q.sentiment_distribution) == (0, 0.0, 0.0, {})
    assert (q.restaurant_name, q.types) == ("Unknown", [])


ANALYSES = (
    "place_id string, restaurant_name string, types array<string>, review_count int, recommendation_score double, "
    "avg_predicted_score double, positive_ratio double, sentiment_distribution map<string,bigint>"
)


@pytest.fixture
def analyses(spark):
    return spark.createDataFrame(
        [
            ("a", "A", ["Bar", "cafe"], 3, 5.0, 5.0, 1.0, {"positive": 3}),
            ("c", "C", ["bar"], 10, 4.0, 4.0, 0.5, {"positive": 5}),
            ("b", "B", ["spa"], 20, 4.0, 3.0, 0.5, {"neutral": 20}),
            ("d", "D", None, 20, 3.5, 2.0, 0.1, {"negative": 20}),
        ],
        ANALYSES,
    )


def test_ranking(analyses):
    ranked = recommend.rank_restaurants(analyses)
    assert rows(ranked.select("rank", "place_id")) == [(1, "b"), (2, "c"), (3, "d")]
    assert recommend.rank_restaurants(analyses, RankingParams(top_n=1)).count() == 1


def test_preferences_keep_global_ranks(analyses):
    def got(**prefs):
        return rows(recommend.recommend(analyses, Preferences(**prefs)).select("rank", "place_id"))

    assert got() == [(1, "b"), (2, "c"), (3, "d")]
    assert got(cuisine_types=("BAR",)) == [(2, "c")]
    assert got(cuisine_types=()) == []
    assert got(min_rating=3.0) == [(1, "b"), (2, "c")]


def test_price_and_place_preferences(spark, analyses):
    facts = [("a", 1, 33.0, -112.0), ("b", 1, 33.0, -112.0), ("c", 3, 33.1, -112.0), ("d", None, None, None)]
    where = spark.createDataFrame(facts, "place_id string, price_level int, latitude double, longitude double")
    known = analyses.join(where, "place_id")
    for wish, places in (
        ({"price_range": (2, 4)}, ["c"]),
        ({"near": (33.0, -112.0), "max_km": 5.0}, ["b"]),
        ({"near": (33.0, -112.0), "max_km": 50.0}, ["b", "c"]),
    ):
        assert [r.place_id for r in recommend.recommend(known, Preferences(**wish)).orderBy("rank").collect()] == places
        row = ("u", None, None, wish.get("price_range"), wish.get("near"), wish.get("max_km"))
        prefs = spark.createDataFrame(
            [row],
            "user_id string, cuisine_types array<string>, min_rating double, price_range array<int>, "
            "near array<double>, max_km double",
        )
        assert [r.place_id for r in recommend.recommend_for_users(known, prefs).orderBy("rank").collect()] == places


def test_lists_of_users_are_freed_of_copies_as_ranks_only(spark, analyses):
    rows = [("u", ["Thai", "bar"], None), ("u", None, None), ("u", ["thai"], 1.0)]
    prefs = spark.createDataFrame(rows, "user_id string, cuisine_types array<string>, min_rating double")
    recs = recommend.recommend_for_users(analyses, prefs, RankingParams(min_reviews=0))
    ranks = [r["rank"] for r in recs.collect()]
    assert ranks and len(ranks) == len(set(ranks)) == recommend.rank_restaurants(analyses, RankingParams(min_reviews=0)).count()
    assert "SortAggregate" not in recs._jdf.queryExecution().executedPlan().toString()


def test_recommend_for_users_equals_one_user_at_a_time(spark, analyses):
    cases = {"all": (None, None), "none": ([], None), "bars": (["Bar", "SPA"], 3.5), "high": (None, 4.5), "twice": (["bar", "BAR"], None)}
    prefs = spark.createDataFrame(
        [(u, c, m) for u, (c, m) in cases.items()], "user_id string, cuisine_types array<string>, min_rating double"
    )
    recs = recommend.recommend_for_users(analyses, prefs)
    together = rows(recs.select("user_id", "rank", "place_id"), "user_id", "rank")
    single = []
    for user, (types, low) in sorted(cases.items()):
        p = Preferences(min_rating=low, cuisine_types=None if types is None else tuple(types))
        single += [(user, *r) for r in rows(recommend.recommend(analyses, p).select("rank", "place_id"))]
    assert together == single
    docs = {r.user_id: r for r in recommend.recommendation_docs(recs, F.lit("now")).collect()}
    assert [x.place_id for x in docs["all"].recommendations] == ["b", "c", "d"]
    assert docs["all"].recommendations[0].sentiment_summary == {"neutral": 20}


def test_top_list_ranks(spark):
    summary = spark.createDataFrame(
        [("a", 4.0, 4.5), ("b", 4.0, 4.5), ("c", 5.0, 3.0), ("d", None, 2.0), ("e", 5.0, 1.0)],
        "place_id string, google_rating double, avg_nlp_score double",
    ).selectExpr(
        "place_id", "place_id name", "place_id address", "google_rating", "avg_nlp_score", "9 nlp_review_count", "0.5 positive_ratio", "1 price_level"
    )
    got = bi.top_restaurants_by_nlp(summary, n=4).select("place_id", "nlp_rank", "google_rank")
    assert rows(got) == [("a", 1, 4), ("b", 1, 4), ("c", 3, 2), ("d", 4, 1)]


def test_rolling_mean_by_rows_and_by_days(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 12)]
    reviews = spark.createDataFrame([(str(i), d) for i, d in enumerate(days)], "review_id string, review_date timestamp")
    preds = spark.createDataFrame([(str(i), 3.0) for i in range(3)], "review_id string, predicted_score double")
    twice = preds.union(preds.filter("review_id = '2'"))
    by_rows = bi.review_volume_trend(twice, reviews, "2024-01-12")
    by_days = bi.review_volume_trend(twice, reviews, "2024-01-12", by_rows=False)
    assert [r.rolling_7d_avg for r in by_rows.orderBy("review_day").collect()] == [1.0, 1.0, 4 / 3]
    assert [r.rolling_7d_avg for r in by_days.orderBy("review_day").collect()] == [1.0, 1.0, 2.0]


def test_labels(spark):
    df = spark.createDataFrame([(0.9,), (0.7,), (0.5,), (0.1,), (None,)], "c double")
    tiers = [r[0] for r in df.select(sentiment.confidence_tier(F.col("c"))).collect()]
    assert tiers == ["High (≥0.9)", "Medium (0.7-0.9)", "Low (0.5-0.7)", "Very Low (<0.5)", "Very Low (<0.5)"]
    df = spark.createDataFrame([(4.0, 1.0), (0.0, 3.5), (None, 2.0), (None, None)], "p double, r double")
    classes = [r[0] for r in df.select(sentiment.score_class(F.col("p"), F.col("r"))).collect()]
    assert classes == ["very-positive", "positive", "negative", "very-negative"]
    df = spark.createDataFrame([(4.0, 3.0), (3.0, 4.0), (3.5, 3.0), (None, 3.0)], "s double, g double")
    got = [r[0] for r in df.select(sentiment.score_alignment(F.col("s"), F.col("g"))).collect()]
    assert got == ["Underrated by Google", "Overrated by Google", "Aligned", "Aligned"]


PLACES = "place_id string, name string, rating double, total_ratings int, types array<string>"


@pytest.fixture
def places(spark):
    return spark.createDataFrame(
        [("a", "Bolt Bar", 5.0, 10, ["bar"]), ("b", "Gear", 4.0, 5, ["BARista"]), ("c", "bolt", 3.0, None, [])], PLACES
    )


@pytest.fixture
def processed(spark):
    return spark.createDataFrame(
        [("r1", "a", 2.0, "negative"), ("r2", "b", 5.0, "very_positive"), ("r3", "b", 4.0, "neutral")],
        "review_id string, place_id string, predicted_score double, sentiment_label string",
    )


def test_search(places, processed):
    def found(**kw):
        return [r.place_id for r in serving.search_restaurants(places, processed, **kw).collect()]

    assert sorted(found()) == ["a", "b", "c"]
    assert sorted(found(q=" BOLT ")) == ["a", "c"]
    assert found(cuisine="bar", limit=1) == ["a"]
    assert found(min_rating=4.5, min_nlp=0) == ["a"]
    # the score filter comes after the limit
    assert found(limit=1, min_nlp=3.0) == []
    row = {r.place_id: r for r in serving.search_restaurants(places, processed).collect()}
    assert (row["b"].avg_nlp_score, row["b"].positive_ratio, row["b"].nlp_review_count) == (4.5, 0.5, 2)
    assert (row["c"].avg_nlp_score, row["c"].positive_ratio, row["c"].nlp_review_count) == (0.0, 0.0, 0)


def test_served_chain(spark, places, processed, analyses):
    docs = recommend.recommendation_docs(recommend.recommend(analyses).withColumn("user_id", F.lit("global")), F.lit("now"))
    none = docs.filter("user_id = 'other'")
    first = serving.served_recommendations(docs, processed, places, cuisine="ARIST")
    assert [(r.rank, r.place_id, r.source) for r in first.collect()] == [(1, "b", "precomputed")]
    live = serving.served_recommendations(none, processed, places).orderBy("rank").collect()
    assert [(r.rank, r.place_id, r.avg_predicted_score, r.positive_ratio) for r in live] == [(1, "b", 4.5, 0.5), (2, "a", 2.0, 0.0)]
    last = serving.served_recommendations(none, processed.limit(0), places, limit=2).orderBy("rank").collect()
    assert [(r.rank, r.place_id, r.source) for r in last] == [(1, "a", "google_rating_fallback"), (2, "b", "google_rating_fallback")]


def test_reviews_of_places(spark, processed):
    raw_reviews = spark.createDataFrame([("x1", "c", 3.0), ("x2", "c", 4.0), ("x3", "a", 5.0)], "review_id string, place_id string, rating double")
    got = serving.place_top_reviews(processed, raw_reviews, 1)
    assert rows(got.select("place_id", "review_id", "source")) == [("a", "r1", "processed"), ("b", "r2", "processed"), ("c", "x2", "raw")]
    assert rows(serving.unprocessed_reviews(raw_reviews, processed, 2).select("review_id")) == [("x1",), ("x2",)]
    assert serving.lookup(raw_reviews, "review_id", "nope").count() == 0


def test_collaborative_prefers_what_similar_users_like(spark):
    data = [(u, p, 5.0 if (u % 2) == (p % 2) else 1.0) for u in range(10) for p in range(10) if (u, p) not in [(0, 2), (0, 3)]]
    ratings = spark.createDataFrame(data, "u int, p int, rating double")
    model = collaborative.train_factors(ratings, "u", "p", "rating", rank=2, max_iter=8)
    candidates = spark.createDataFrame([(0, 3, 1), (0, 2, 2), (99, 3, 1), (99, 2, 2)], "u int, p int, rank int")
    got = collaborative.order_candidates(model, candidates).orderBy("u", "position").collect()
    assert [(r.u, r.p, r.position) for r in got] == [(0, 2, 1), (0, 3, 2), (99, 3, 1), (99, 2, 2)]
    assert got[0].predicted_rating > 4 and got[2].predicted_rating is None


def test_ids_are_dense_for_large_and_for_text_keys(spark):
    keys = spark.range(0, 1000, numPartitions=7).select(((F.col("id") % 300) + (1 << 40)).alias("k"))
    for found in (keys, keys.select(F.concat(F.lit("u"), "k").alias("k")), keys.filter("k < 0")):
        ids = collaborative.dense_ids(found.unionByName(found.limit(1).select(F.lit(None).cast(found.dtypes[0][1]).alias("k"))), "k", "n").collect()
        assert sorted(r.n for r in ids) == list(range(found.distinct().count())) and len({r.k for r in ids}) == len(ids)


SCORES = "review_id string, place_id string, predicted_score decimal(3,2), sentiment_label string, confidence decimal(5,4)"


def test_summary_by_batch_equals_a_recompute(spark):
    """Batches that add, revise and take away predictions leave the summary of what is left."""
    import random
    from decimal import Decimal

    from platewise.plans import ingestion
    from platewise.session import new_work_path

    rng = random.Random(5)
    labels = ["positive", "very_positive", "negative", "neutral", None]

    def prediction(k):
        score = rng.choice([None, Decimal(rng.randrange(100, 501)) / 100])
        return (f"r{k}", rng.choice([None, *"abcd"]), score, rng.choice(labels), Decimal(rng.randrange(10001)) / 10000)

    places = spark.createDataFrame(
        [(p, p.upper(), "", 4.0, 7, 1) for p in "abcde"],
        "place_id string, name string, address string, rating double, total_ratings int, price_level int",
    )
    path, now = new_work_path(spark, "summary"), {}
    for turn in range(4):
        batch = [prediction(k) for k in (range(60) if turn == 0 else rng.sample(range(110), 30))]
        gone = [now[r[0]] for r in batch if r[0] in now]
        if turn == 3:  # place b loses all of its predictions
            gone += [r for k, r in now.items() if r[1] == "b" and k not in {x[0] for x in batch}]
            batch = [r for r in batch if r[1] != "b"]
        for r in gone:
            del now[r[0]]
        now |= {r[0]: r for r in batch}
        removed = None if turn == 0 else spark.createDataFrame(gone, SCORES)
        found = ingestion.refresh_summary_by_batch(places, spark.createDataFrame(batch, SCORES), path, removed)
        expected = star.sentiment_summary(places, spark.createDataFrame(list(now.values()), SCORES))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    with pytest.raises(ValueError):
        ingestion.refresh_summary_by_batch(places, spark.createDataFrame([], SCORES), new_work_path(spark, "none"), removed)


def test_preferences_keep_range_and_time(spark):
    stored = spark.createDataFrame(
        [("u", ["old"], 2.0, [1, 2], "then"), ("v", [], 4.0, None, "then")],
        "user_id string, cuisine_types array<string>, min_rating double, price_range array<int>, updated_at string",
    )
    sent = spark.createDataFrame(
        [("u", None, None, None), (None, ["thai"], 1.0, [2, 3])],
        "user_id string, cuisine_types array<string>, min_rating double, price_range array<int>",
    )
    now = F.lit("now")
    found = {r[0]: tuple(r)[1:] for r in merge.upsert_preferences(stored, sent, updated_at=now).collect()}
    assert found == {
        "u": ([], 3.0, None, "now"),
        "v": ([], 4.0, None, "then"),
        "anonymous": (["thai"], 1.0, [2, 3], "now"),
    }
    without = merge.upsert_preferences(stored, sent.drop("price_range")).collect()
    assert {r.user_id: r.price_range for r in without} == {"u": None, "v": None, "anonymous": None}
