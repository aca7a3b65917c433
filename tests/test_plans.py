"""Plans stay distributed: no Python but where needed, no unbounded single task."""

import itertools
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from platewise.operators import analysis, bi, dedup, merge, star
from platewise.plans import bindings as b
from platewise.plans import queries as q
from platewise.session import new_work_path

SF_DIR = "/root/testdata/sf0.001"
PACKAGE = Path(__file__).resolve().parent.parent / "platewise"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


WITH_PYTHON = {
    "normalize_text",
    "truncate_words",
    "key_phrases",
    "score_reviews",
    "score_reviews_batched",
    "score_reviews_trained",
    "ensure_scored",
    "score_backlog",
    "prediction_rows",
    "analyze_partly_scored",
    "batch_summary",
    "clean_batch_counts",
}
RUNS_AT_ONCE = {"score_reviews_trained", "als_recommendations", "als_errors", "als_new_places"}


@pytest.mark.parametrize("name", sorted(set(q.REGISTRY) - RUNS_AT_ONCE))
def test_python_and_cross_joins(spark, name):
    text = plan(entry_point.queries()[name](spark, SF_DIR))
    assert ("EvalPython" in text) == (name in WITH_PYTHON)
    assert "BatchEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_month_of_the_lake_prunes_folders(spark):
    text = plan(entry_point.queries()["read_lake_month"](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 1995[^\]]*month#\d+ = 6", text)


def test_no_collecting_in_the_library():
    # the llm package fits models on bounded samples; its own tests list what it brings to the driver
    for path in (p for p in PACKAGE.rglob("*.py") if "llm" not in p.relative_to(PACKAGE).parts):
        source = path.read_text()
        assert not re.search(r"\.(collect|toPandas|localCheckpoint|toLocalIterator|crossJoin)\(", source), path


# the sorts of one place, day or rating value each, or of rows cut by a limit
@pytest.mark.parametrize("name", ["dedup_reviews", "clean_reviews", "restaurant_stats", "upsert_reviews", "place_top_reviews"])
def test_no_single_partition(spark, name):
    assert "SinglePartition" not in plan(entry_point.queries()[name](spark, SF_DIR))


def test_dedup_limits_groups_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 review_id", "cast(id as string) ingested_at", "id v")
    text = plan(dedup.dedup_reviews(rows))
    assert text.count("WindowGroupLimit") == 2
    assert re.search(r"Exchange hashpartitioning\(review_id.*\n.*WindowGroupLimit", text)


def test_place_aggregation_is_partial_before_the_shuffle(spark):
    scored = b.processed(spark, SF_DIR)
    text = plan(star.sentiment_summary(b.restaurants(spark, SF_DIR), scored))
    assert len(re.findall(r"HashAggregate\(keys=\[place_id.*partial_count", text)) == 1
    assert text.index("Join") < text.index("partial_count")
    assert "partial_sum" in plan(analysis.place_scores(scored))


def test_scan_reads_needed_columns_and_recent_rows(spark):
    text = plan(q.review_volume_trend(spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    scans = re.findall(r"ReadSchema: struct<(.*?)>", plan(b.restaurants(spark, SF_DIR).select("place_id", "name")))
    assert scans == ["p_partkey:bigint,p_name:string"]


def test_both_sides_of_the_review_join_share_one_shuffle(spark):
    text = final_plan(bi.confidence_tiers(b.predictions(spark, SF_DIR), b.reviews(spark, SF_DIR)))
    assert "ReusedExchange" in text[: text.index("== Initial Plan")]


def test_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(100_000).selectExpr("id k", "id v")
    path = new_work_path(spark, "batch")
    spark.createDataFrame([(1, 2)], "k bigint, v bigint").write.parquet(path)
    batch = spark.read.parquet(path)
    text = plan(merge.merge_by_key(target, batch, "k", small_updates=True))
    assert "SortMergeJoin" not in text
    # the batch is shuffled to reduce its copies; no shuffle has the target below it
    lines = [x for x in text.splitlines() if re.search("[A-Za-z]", x)]
    depths = [re.search("[A-Za-z]", x).start() for x in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = itertools.takewhile(lambda k: depths[k] > depths[i], range(i + 1, len(lines)))
            assert not any("Range" in lines[k] for k in below), text


def test_hot_keys_give_whole_results(spark):
    """A third of all rows on one place and one review id."""
    n = 30_000
    rows = spark.range(n).selectExpr(
        "if(id % 3 = 0, 'hot', concat('r', id)) review_id",
        "if(id % 3 = 0, 'P', concat('p', id % 100)) place_id",
        "cast(id as string) ingested_at",
        "cast(1 + id % 5 as double) predicted_score",
        "'neutral' sentiment_label",
        "0.5D confidence",
    )
    assert dedup.dedup_reviews(rows).count() == 1 + 2 * n // 3
    scores = {r.place_id: r for r in analysis.place_scores(rows).collect()}
    assert scores["P"].review_count == n // 3 and sum(r.review_count for r in scores.values()) == n
    assert scores["P"].sentiment_distribution == {"neutral": n // 3}
    top = dedup.top_per_key(rows, ["place_id"], [F.desc("predicted_score"), F.col("ingested_at")], 50)
    assert top.filter("place_id = 'P'").count() == 50
    order = [F.desc("predicted_score"), F.col("ingested_at")]
    many = dedup.top_per_key(rows, ["place_id"], order, 1500).filter("place_id = 'P'")
    expected = rows.filter("place_id = 'P'").orderBy(*order).limit(1500)
    assert many.count() == 1500 and many.exceptAll(expected).count() == 0
