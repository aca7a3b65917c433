import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from platewise import schemas
from platewise.operators import merge
from platewise.plans import ingestion
from platewise.session import new_work_path, work_root
from platewise.sources import bucketed, documents, lake, snapshots
from platewise.streaming import ingest as streaming

PLACE = {
    "place_id": "p1",
    "name": "Cafe",
    "reviews": [
        {
            "author_name": "Ann",
            "rating": 5,
            "text": "Great <b>coffee</b> here",
            "language": "en",
            "time": 1700000000,
            "relative_time_description": "a day ago",
            "profile_photo_url": "u",
        },
        {"author_name": "Bob", "rating": 3, "text": "It was fine", "time": 1700086400},
    ],
}


def test_rows_with_nulls_and_whole_numbers(spark):
    df = documents.reviews_from_rows(spark, [{"review_id": "a", "rating": 4}, {"review_id": "b", "rating": None}, {"text": "x"}])
    assert [(r.review_id, r.rating) for r in df.collect()] == [("a", 4.0), ("b", None), (None, None)]
    assert documents.require_key(df, "review_id").count() == 2
    places = documents.restaurants_from_rows(spark, [{"place_id": "p", "types": ["a", "b"], "latitude": 33.4}])
    assert places.first().types == ["a", "b"]


def test_flatten_reviews(spark):
    places = documents.from_rows(spark, [PLACE, {"name": None, "reviews": [{}]}, {"place_id": "p3"}], schemas.PLACE_DETAILS)
    got = {r.author_name: r for r in documents.flatten_reviews(places, F.lit("now")).collect()}
    assert set(got) == {"Ann", "Bob", "Anonymous"}
    ann, bob, nobody = got["Ann"], got["Bob"], got["Anonymous"]
    assert ann.review_id == hashlib.md5(b"p1_Ann_1700000000").hexdigest()
    assert ann.review_time == "2023-11-14T22:13:20+00:00" and ann.relative_time == "a day ago"
    assert (bob.language, bob.relative_time, bob.profile_photo_url) == ("en", "", "")
    assert nobody.review_id == hashlib.md5(b"unknown__").hexdigest()
    assert (nobody.place_id, nobody.restaurant_name, nobody.text, nobody.rating) == ("unknown", "Unknown", "", None)
    assert nobody.review_time == "1970-01-01T00:00:00+00:00"
    assert documents.flatten_reviews(places).columns == schemas.RAW_REVIEW.fieldNames()


def test_restaurant_metadata(spark):
    full = {
        "place_id": "p",
        "name": "N",
        "formatted_address": "A 1",
        "geometry": {"location": {"lat": 33.4, "lng": -111.9}},
        "rating": 4.5,
        "user_ratings_total": 7,
        "price_level": 2,
        "types": ["bar", "food"],
    }
    places = documents.from_rows(spark, [full, {"place_id": "q"}], schemas.PLACE_DETAILS)
    p, q = documents.restaurant_metadata(places, F.lit("now")).orderBy("place_id").collect()
    assert tuple(p) == ("p", "N", "A 1", 33.4, -111.9, 4.5, 7, 2, ["bar", "food"], "now")
    assert tuple(q) == ("q", None, "", None, None, None, 0, None, [], "now")


def test_batches(spark):
    batch = {"location": "Tempe", "reviews": [{"review_id": "a"}, {"review_id": "b"}]}
    df = documents.from_rows(spark, [batch, {"location": "X", "reviews": []}], schemas.EXTRACTION_BATCH)
    assert sorted(r.review_id for r in documents.batch_reviews(df).collect()) == ["a", "b"]


def test_lake(spark):
    path = new_work_path(spark, "lake") + "/" + lake.RAW_PREFIX
    df = documents.reviews_from_rows(spark, [{"review_id": "a", "text": "ä"}, {"review_id": "b"}])
    lake.write_lake(df, path, F.lit("Phoenix Downtown"), F.lit("2024-03-05"))
    lake.write_lake(df.limit(1), path, F.lit("Tempe"), F.lit("2024-11-05"))
    march = lake.read_lake(spark, path, schemas.RAW_REVIEW, 2024, 3, 5)
    assert sorted((r.review_id, r.text, r.location, r.month) for r in march.collect()) == [
        ("a", "ä", "phoenix_downtown", 3),
        ("b", None, "phoenix_downtown", 3),
    ]
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    files = [r.file_path for r in lake.lake_files(spark, path, 2024, 3, 5).collect()]
    assert files and all("year=2024/month=03/day=05" in f for f in files)
    assert lake.read_lake(spark, path, schemas.RAW_REVIEW).count() == 3


def test_a_rerun_replaces_its_day_and_location(spark):
    path = new_work_path(spark, "lake")
    schema = schemas.RAW_REVIEW

    def put(rows, location, day, **how):
        lake.write_lake(documents.reviews_from_rows(spark, [{"review_id": r} for r in rows]), path, location, F.lit(day), **how)

    put(["a", "b"], F.lit("Tempe"), "2024-03-05")
    put(["c"], F.lit("Mesa"), "2024-03-05")
    put(["d"], F.lit("Tempe"), "2024-03-06")
    for _ in range(2):
        put(["a", "x", "y"], F.lit("Tempe"), "2024-03-05")
    found = lake.read_lake(spark, path, schema)
    rows = sorted((r.review_id, r.location, r.day) for r in found.collect())
    assert rows == [("a", "tempe", 5), ("c", "mesa", 5), ("d", "tempe", 6), ("x", "tempe", 5), ("y", "tempe", 5)]
    put(["z"], F.lit("Mesa"), "2024-03-05", replace=False)
    mesa = lake.read_lake(spark, path, schema, 2024, location="Mesa")
    assert sorted(r.review_id for r in mesa.collect()) == ["c", "z"]
    plan = mesa._jdf.queryExecution().executedPlan().toString()
    assert "location#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_both_areas_of_the_lake(spark):
    path = new_work_path(spark, "areas")
    places = documents.from_rows(spark, [PLACE], schemas.PLACE_DETAILS)
    for _ in range(2):
        out = ingestion.ingest(places, "2023-12-01", F.lit("2023-11-20"), path, F.lit("New Town"))
    raw = lake.read_lake(spark, f"{path}/{lake.RAW_PREFIX}", schemas.RAW_REVIEW, 2023, 11, 20)
    assert {r.location for r in raw.collect()} == {"new_town"} and raw.count() == out["raw_reviews"].count()
    done = lake.read_lake(spark, f"{path}/{lake.PROCESSED_PREFIX}", out["reviews"].schema, location="new town")
    names = ["review_id", "text_cleaned", "word_count", "review_age_days"]
    assert sorted(done.select(*names).collect()) == sorted(out["reviews"].select(*names).collect())
    with pytest.raises(ValueError):
        ingestion.ingest(places, "2023-12-01", F.lit("2023-11-20"), path)


def test_a_batch_of_one_folder_is_compressed_and_not_shuffled(spark):
    path = new_work_path(spark, "lake")
    df = documents.reviews_from_rows(spark, [{"review_id": str(i), "text": "same text " * 40} for i in range(50)])
    lake.write_lake(df.repartition(3), path, "Phoenix Downtown", "2024-03-05")
    files = [r.file_path for r in lake.lake_files(spark, path).collect()]
    assert len(files) == 3 and all(f.endswith(".json.gz") and "/location=phoenix_downtown/" in f for f in files)
    assert lake.read_lake(spark, path, schemas.RAW_REVIEW, 2024, 3, 5, location="Phoenix Downtown").count() == 50
    # days and places that differ by row still come together before they are written
    lake.write_lake(df.repartition(3), path, F.lit("Tempe"), F.lit("2024-03-05"))
    assert len([r for r in lake.lake_files(spark, path).collect() if "location=tempe" in r.file_path]) == 1


def test_stored_reviews_are_compressed(spark):
    path = new_work_path(spark, "json")
    df = documents.reviews_from_rows(spark, [{"review_id": str(i), "text": "ä\n" * i} for i in range(20)])
    documents.write_reviews_json(df, path)
    assert spark.read.format("binaryFile").load(path).filter("path NOT LIKE '%.json.gz'").count() == 0
    assert documents.read_reviews_json(spark, path).exceptAll(df).count() == 0
    assert documents.read_reviews_json(spark, path).count() == 20


def test_files_with_one_array(spark, tmp_path):
    (tmp_path / "tempe_1.json").write_text(json.dumps([{"review_id": "a", "rating": 2}, {"review_id": "b"}], indent=2))
    df = documents.read_reviews_json(spark, str(tmp_path), multi_line=True)
    assert sorted(r.review_id for r in df.collect()) == ["a", "b"]


def test_snapshots(spark):
    path = new_work_path(spark, "table")
    assert snapshots.versions(spark, path) == []
    first = snapshots.write_version(spark.range(3), path)
    second = snapshots.write_version(snapshots.read_latest(spark, path).filter("id > 0"), path)
    assert (first.count(), second.count(), snapshots.read_latest(spark, path).count()) == (3, 2, 2)
    assert len(snapshots.versions(spark, path)) == 2
    snapshots.write_version(spark.range(9), path, "99999999999999999999")
    snapshots.write_version(spark.range(7), path, "99999999999999999999")
    assert snapshots.read_latest(spark, path).count() == 7
    # the two last finished versions stay
    assert [v[-20:] for v in snapshots.versions(spark, path)][-1] == "9" * 20
    assert len(snapshots.versions(spark, path)) == 2 and second.count() == 2


def test_work_folder_comes_from_the_session(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_work_path(spark, "a") != new_work_path(spark, "a")


def test_ingest_and_batch_job_agree(spark):
    places = documents.from_rows(spark, [PLACE, PLACE], schemas.PLACE_DETAILS)
    out = ingestion.ingest(places, "2023-12-01", F.lit("2023-11-20"))
    assert out["raw_reviews"].count() == 4 and out["reviews"].count() == 2
    assert sorted(r.review_age_days for r in out["fact_reviews"].collect()) == [16, 17]
    assert out["dim_time"].count() == 2 and out["dim_restaurants"].collect() == [("p1", "Cafe")]
    assert out["restaurant_stats"].first().avg_rating == 4.0

    source, target = new_work_path(spark, "in"), new_work_path(spark, "out")
    out["raw_reviews"].write.json(source)
    done = ingestion.process_reviews(spark, source, target)
    assert (done["input_rows"], done["output_rows"]) == (4, 2)
    assert done["reviews"].count() == 2 and done["top"].first().avg_rating == 4.0
    assert spark.read.parquet(f"{target}/restaurant_stats").count() == 1


def test_stream_keeps_latest_of_each_id_and_resumes(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    schema = "review_id string, place_id string, author_name string, rating double, text string, time_epoch bigint, event_time timestamp"

    def put(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder / name))

    def run():
        source = streaming.file_stream(spark, str(folder / "*"), spark.createDataFrame([], schema).schema)
        streaming.ingest_reviews(source, out, state, as_of="2024-01-03").awaitTermination()
        return sorted((r.review_id, r.text_cleaned, r.rating) for r in streaming.read_stream_table(spark, out, "review_id").collect())

    at = dt.datetime(2024, 1, 1, 12)
    a = ("a", "p", "x", 9.0, "<b>Great</b> place", 1704110400, at)
    put("1", [a, a, ("b", "p", "x", 1.0, "no", 1704110400, at)])
    assert run() == [("a", "Great place", 5.0)]
    put("2", [a, ("c", "p", "x", 2.0, "Quite bad", 1704110400, at)])
    assert run() == [("a", "Great place", 5.0), ("c", "Quite bad", 2.0)]
    assert run() == [("a", "Great place", 5.0), ("c", "Quite bad", 2.0)]
    # an edited copy, an older copy of another, and a review of an earlier year
    edited = ("a", "p", "x", 1.0, "Went downhill", 1704200000, at + dt.timedelta(days=1))
    older = ("c", "p", "x", 4.0, "Was good then", 1600000000, at - dt.timedelta(days=900))
    early = ("d", "p", "x", 3.0, "Opened lately", 1500000000, at - dt.timedelta(days=2000))
    put("3", [edited, older, early])
    expected = [("a", "Went downhill", 1.0), ("c", "Quite bad", 2.0), ("d", "Opened lately", 3.0)]
    assert run() == expected
    for n in range(4):
        put(f"again{n}", [edited])
        assert run() == expected
    # a compaction changes nothing, and the next one removes what the one before covers
    for n in range(3):
        streaming.compact(spark, out, "review_id")
        put(f"more{n}", [("e", "p", "x", 3.0, f"Text number {n}", 1700000000 + n, at + dt.timedelta(hours=n))])
        assert run() == [*expected, ("e", f"Text number {n}", 3.0)]
    folders = {int(f.name.split("=")[1]) for f in (tmp_path / "out" / "batches").iterdir()}
    covered = sorted(int(f.name.split("=")[1]) for f in (tmp_path / "out" / "whole").iterdir() if f.is_dir())
    assert len(covered) == 2 and min(folders) == covered[0] + 1 and max(folders) > covered[1]


def test_latest_copy_does_not_depend_on_batches(spark, tmp_path):
    """Every split of the same rows into batches, with ties and nulls, leaves the same table."""
    import random

    rng = random.Random(3)
    schema = "k string, at int, v string, w double"
    rows = [(f"k{rng.randrange(12)}", rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"]), rng.choice([None, 0.5, 2.0])) for _ in range(90)]

    def newest(r):
        return tuple((x is not None, x) for x in r[1:])

    expected = {}
    for r in rows:
        expected[r[0]] = max(expected.get(r[0], r), r, key=newest)
    for number, size in enumerate((90, 23)):
        folder, out, state = (str(tmp_path / f"{name}{number}") for name in ("in", "out", "state"))
        rng.shuffle(rows)
        for start in range(0, len(rows), size):
            spark.createDataFrame(rows[start : start + size], schema).write.mode("append").parquet(folder)
            source = streaming.file_stream(spark, folder, spark.createDataFrame([], schema).schema)
            streaming.append_batches(streaming.latest_copies(source, "k", ["at"]), out, state).awaitTermination()
        found = {tuple(r) for r in streaming.read_stream_table(spark, out, "k").collect()}
        assert found == set(expected.values())


def test_a_batch_reads_no_earlier_batches(spark, tmp_path):
    """What a batch writes is its own folder; the folders before stay as they were."""
    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "k int, at int"
    seen = {}
    for n in range(4):
        spark.createDataFrame([(n % 2, n)], schema).coalesce(1).write.mode("append").parquet(folder)
        source = streaming.file_stream(spark, folder, spark.createDataFrame([], schema).schema)
        streaming.append_batches(streaming.latest_copies(source, "k", ["at"]), out, state).awaitTermination()
        files = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet")}
        assert {f: files[f] for f in seen} == seen
        new = {f for f in files if f not in seen}
        assert new and all(f"batch={n}/" in f for f in new)
        assert spark.read.parquet(*new).select("k", "at").collect() == [(n % 2, n)]
        seen = files


def test_stream_counts_equal_batch(spark, tmp_path):
    folder, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    schema = "place_id string, event_time timestamp"

    def put(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        source = streaming.file_stream(spark, str(folder), spark.createDataFrame([], schema).schema)
        counts = streaming.windowed_counts(source, "place_id")
        streaming.append_batches(counts, table, state).awaitTermination()
        got = streaming.read_stream_table(spark, table, "window_key").collect()
        return sorted((r.window_start.day, r.place_id, r.review_count) for r in got)

    put([("p", dt.datetime(2024, 1, 1, 1)), ("p", dt.datetime(2024, 1, 1, 2)), ("q", dt.datetime(2024, 1, 2, 1))])
    assert run() == [(1, "p", 2), (2, "q", 1)]
    put([("p", dt.datetime(2024, 1, 1, 5)), ("q", dt.datetime(2024, 1, 3)), ("q", dt.datetime(2020, 1, 9))])
    assert run() == [(1, "p", 3), (2, "q", 1), (3, "q", 1), (9, "q", 1)]


# --- bucketed tables -----------------------------------------------------------------


def _below_exchanges(df):
    """The lines of the plan that lie below a shuffle."""
    lines = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if any(c.isalpha() for c in x)]
    depth = [next(k for k, c in enumerate(x) if c.isalpha()) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "Exchange " in line:
            for k in range(i + 1, len(lines)):
                if depth[k] <= depth[i]:
                    break
                found.append(lines[k])
    return found


def test_bucketed_merge_leaves_the_target_in_place(spark):
    table = bucketed.BucketedTable(new_work_path(spark, "bucketed"), "k", 8)
    target = spark.range(2000).selectExpr("concat('k', id) k", "id v", "id % 7 w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed.write(target, table)
        for turn in range(3):
            batch = spark.range(1500 + turn * 600, 2200 + turn * 600).selectExpr("concat('k', id) k", f"id * 10 + {turn} v")
            batch = batch.unionByName(batch.limit(50))
            plan = bucketed.merged(table, batch, update_cols=["v"])
            below = _below_exchanges(plan)
            assert below and not any("Scan parquet" in line for line in below)
            assert "Bucketed: true" in plan._jdf.queryExecution().executedPlan().toString()
            expected = merge.merge_by_key(target, batch, "k", ["v"])
            target = bucketed.merge_into(table, batch, update_cols=["v"])
            assert sorted(map(tuple, target.collect())) == sorted(map(tuple, expected.collect()))
            files = target.inputFiles()
            assert len(files) <= 8
            target = spark.createDataFrame(target.collect(), target.schema)
        assert len(snapshots.versions(spark, table.path)) == 2
        todo = bucketed.read(spark, table).join(bucketed.read(spark, table).select("k"), "k", "left_anti")
        assert not _below_exchanges(todo) and todo.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_table_of_another_session(spark):
    table = bucketed.BucketedTable(new_work_path(spark, "bucketed"), "k", 4)
    with pytest.raises(FileNotFoundError):
        bucketed.read(spark, table)
    rows = [("a", 1, ["x"]), (None, 2, None), ("b", None, [])]
    first = bucketed.merge_into(table, spark.createDataFrame(rows, "k string, v int, t array<string>"))
    assert sorted(map(tuple, first.collect()), key=repr) == sorted(rows, key=repr)
    # the catalog forgets it, as a new session's would
    spark.sql(f"DROP TABLE {bucketed._name(table, snapshots.versions(spark, table.path)[-1])}")
    again = bucketed.read(spark, table)
    assert again.filter("k = 'a'").first().v == 1 and again.count() == 3
