"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node in links (``a``, ``b``).

    Each round joins every node's neighbours not smaller than it to its smallest neighbour
    (large star), then its smaller neighbours to the smallest of them (small star), until
    the links no longer change: they are then stars around the smallest nodes. Rounds grow
    with the logarithm of the longest path. The links of each round are written to the
    shared work folder, so a lost executor costs no more than a round.
    """
    now = saved(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("least").alias("a"), "b")
        large = large.filter("a < b").distinct()
        small = large.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("least"))
        joined = large.join(small, large["b"] == small["node"])
        now = saved(
            joined.select(F.col("least").alias("a"), F.col("a").alias("b"))
            .filter("a < b")
            .unionByName(small.select(F.col("least").alias("a"), F.col("node").alias("b")))
            .distinct(),
            "links",
        )
        before, mark = mark, _mark(now)
        if mark == before:
            break
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return stars.unionByName(centres)


def _mark(links: DataFrame) -> tuple:
    """The number of links and a sum over them: equal if they haven't changed."""
    return tuple(
        links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )
