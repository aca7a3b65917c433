"""Trigram postings of names and tags, which cut the places a search pattern is tried on."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 3
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NAME, TAG = "name", "tag"
#: alternatives of letters, digits and blanks only; any other pattern has no trigrams that must occur
PLAIN = re.compile(r"[A-Za-z0-9 ]{3,}(\|[A-Za-z0-9 ]{3,})*")


def _grams(text: Column) -> Column:
    """Distinct trigrams, A-Z in lower case as search patterns fold only these."""
    folded = F.translate(text, CAPITALS, SMALL)
    places = F.sequence(F.lit(1), F.greatest(F.length(folded) - SIZE + 1, F.lit(1)))
    return F.transform(places, lambda i: F.substr(folded, i, F.lit(SIZE)))


def trigram_postings(restaurants: DataFrame) -> DataFrame:
    """Rows of field, gram and place_id; nulls have none. Write them with ``sources.lookup`` sorted in this order."""
    fields = {
        NAME: F.coalesce(_grams(F.col("name")), F.array().cast("array<string>")),
        TAG: F.flatten(F.transform(F.filter(F.coalesce("types", F.array().cast("array<string>")), F.isnotnull), _grams)),
    }
    parts = [
        restaurants.select(F.lit(field).alias("field"), F.explode(F.array_distinct(grams)).alias("gram"), "place_id")
        for field, grams in fields.items()
    ]
    return parts[0].unionByName(parts[1]).filter(F.col("place_id").isNotNull())


def candidates(postings: DataFrame, field: str, pattern: str) -> DataFrame | None:
    """Ids of the places that may match: they hold all trigrams of an alternative. None if the pattern names no trigrams."""
    if not PLAIN.fullmatch(pattern):
        return None
    # the same folding as of the texts; a pattern is plain ASCII here
    needed = [sorted({a[i : i + SIZE] for i in range(len(a) - SIZE + 1)}) for a in pattern.lower().split("|")]
    every = sorted({g for grams in needed for g in grams})
    held = postings.filter((F.col("field") == field) & F.col("gram").isin(every))
    # a place has at most one entry per trigram of the pattern
    found = held.groupBy("place_id").agg(F.collect_set("gram").alias("held"))
    whole = [F.size(F.array_intersect("held", F.array(*map(F.lit, grams)))) == len(grams) for grams in needed]
    return found.filter(F.array_contains(F.array(*whole), True)).select("place_id")
