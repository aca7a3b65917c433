"""A search by trigrams finds what the scan finds."""

import pytest
from pyspark.sql import functions as F

from platewise.operators import postings, serving

NAMES = ["Bolt & Gear", "bolt", "BO LT", "abcab", "Kelvin bar", "Kelvin", "ärger Bolt", "", None, "bo", "gearbox 12", "İstanbul bolt", "a.c", "x boltgear x"]
PATTERNS = ["bolt", "BOLT|gear", "bo", "b.lt", "(bolt)", "kel", "kelvin|12", "no such", "abcabc", "bolt|", "a\\.c", "", "  gear  ", "İst", "x bolt", "^bolt$"]


@pytest.fixture(scope="module")
def places(spark):
    rows = [(f"p{i}", n, [n, "Small Bar"] if i % 3 else [None, "gear"], i / 10) for i, n in enumerate(NAMES)]
    rows.append(("none", "bolt", None, 9.0))
    return spark.createDataFrame(rows, "place_id string, name string, types array<string>, rating double")


@pytest.mark.parametrize("pattern", PATTERNS)
def test_every_pattern_finds_what_the_scan_finds(spark, places, pattern):
    reviews = spark.createDataFrame([("p0", 3.0, "neutral")], "place_id string, predicted_score double, sentiment_label string")
    index = postings.trigram_postings(places)
    for wish in ({"q": pattern}, {"cuisine": pattern}, {"q": "bolt", "cuisine": pattern}):
        plain = serving.search_restaurants(places, reviews, **wish).select("place_id")
        found = serving.search_restaurants(places, reviews, **wish, postings=index).select("place_id")
        assert sorted(found.collect()) == sorted(plain.collect())


def test_candidates_are_few_and_patterns_without_trigrams_have_none(spark, places):
    index = postings.trigram_postings(places)
    assert postings.candidates(index, postings.NAME, "b.lt") is None and postings.candidates(index, postings.NAME, "bo") is None
    found = {r.place_id for r in postings.candidates(index, postings.NAME, "BOLT|box 12").collect()}
    assert found == {"p0", "p1", "p6", "p10", "p11", "p13", "none"}
    assert index.groupBy("field", "gram", "place_id").count().filter(F.col("count") > 1).count() == 0
    assert postings.trigram_postings(places.limit(0)).count() == 0
