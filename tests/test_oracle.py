"""Every query against its SQL, on the given tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from platewise.plans import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _cell(value):
    return repr(float(value)) if isinstance(value, (float, Decimal)) else repr(value)


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_sql_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    own = set(entry_point.queries()) - set(entry_point.LLM_QUERIES)
    assert own <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    expected_types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    assert {c: TYPE_NAMES.get(t, t) for c, t in df.dtypes} == expected_types
    actual = df.collect()
    assert len(actual) == len(expected) > 0
    assert _sorted_rows(actual, df.columns) == _sorted_rows(expected, [c[0] for c in cursor.description])


def test_trained_scores_are_whole(spark):
    rows = queries.trained_scores(spark, SF_DIR).collect()
    assert len(rows) >= spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(1 <= r.predicted_score <= 5 and 0 <= r.confidence <= 1 for r in rows)
    # a text without content is neutral
    assert {(r.predicted_score, r.sentiment_label, r.confidence) for r in rows if r.confidence == 0} == {
        (3.0, "neutral", 0.0)
    }


def test_collaborative_order_keeps_every_candidate(spark):
    lists = entry_point.queries()["recommend_for_users"](spark, SF_DIR).select("user_id", "place_id", "rank")
    rows = queries.ordered_lists(spark, SF_DIR).collect()
    assert sorted((r.user_id, r.place_id, r.rank) for r in rows) == sorted(tuple(r) for r in lists.collect())
    by_user: dict = {}
    for r in sorted(rows, key=lambda r: (r.user_id, r.position)):
        by_user.setdefault(r.user_id, []).append(r)
    for found in by_user.values():
        assert [r.position for r in found] == list(range(1, len(found) + 1))
        scores = [r.predicted_rating for r in found if r.predicted_rating is not None]
        assert scores == sorted(scores, reverse=True)


def test_collaborative_order_uses_the_customers_orders(spark, duck):
    bought = {r[0] for r in duck.execute("SELECT DISTINCT concat('U', o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey").fetchall()}
    rows = queries.ordered_lists(spark, SF_DIR).collect()
    assert {r.user_id for r in rows} & bought
    assert {r.user_id for r in rows if r.predicted_rating is not None} == {r.user_id for r in rows} & bought
    in_order: dict = {}
    for r in sorted(rows, key=lambda r: (r.user_id, r.rank)):
        in_order.setdefault(r.user_id, []).append(r.position)
    assert any(found != sorted(found) for found in in_order.values())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
