"""Document fingerprints: threshold-scaled sketches of word shingles, in SQL functions only.

Every shingle of five words gets a hash of 60 bits, and a text's sketch is all of its
hashes below a fixed fraction of their range. So a sketch is a sample of the text's
shingles that two texts take alike, whatever their lengths: what sketches share estimates
what texts share, the union of sketches is the sketch of the texts together, and a short
text can be looked for in a very long one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from platewise.llm.common import once

HASH_DIGITS = 15


@dataclass(frozen=True)
class SketchParams:
    #: words of a shingle; a text of fewer words is one shingle
    shingle: int = 5
    #: of so many hashes one is kept
    scale: int = 4
    #: ranges of ids that texts are dealt to, for each shuffle partition, and at most
    blocks_per_partition: int = 4
    most_blocks: int = 1 << 16


def limit(params: SketchParams) -> int:
    """Hashes below are kept."""
    return 16**HASH_DIGITS // params.scale


def sketch(text: Column, params: SketchParams = SketchParams()) -> Column:
    """The sorted distinct hashes of a text's shingles that lie below the limit; the smallest one if none does.

    Words are parted by blanks and 0x09 to 0x0D. A null text and one without words have an
    empty sketch. With the smallest hash standing in, every other text has a sketch; in a
    union it gives way as soon as there is a hash below the limit.
    """

    def hashed(words: Column) -> Column:
        # words beyond the end are null, which the concatenation skips
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - params.shingle, F.lit(0)))
        return F.transform(
            starts,
            lambda k: F.substring(
                F.md5(F.concat_ws(" ", *[F.get(words, k + i) for i in range(params.shingle)]).cast("binary")),
                1,
                HASH_DIGITS,
            ),
        )

    below = f"{limit(params):0{HASH_DIGITS}x}"

    def kept(hashes: Column) -> Column:
        return once(
            F.filter(hashes, lambda h: h < F.lit(below)),
            lambda few: F.when(F.size(few) > 0, few).otherwise(F.array(F.array_min(hashes))),
        )

    def of_words(words: Column) -> Column:
        numbers = F.transform(once(hashed(words), kept), lambda h: F.conv(h, 16, 10).cast("bigint"))
        return F.when(F.size(words) > 0, F.sort_array(F.array_distinct(numbers))).otherwise(
            F.array().cast("array<bigint>")
        )

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return once(words, of_words)


def printed(own: Column) -> Column:
    """A sketch as text: its hashes in 15 hexadecimal digits each, in order."""
    return F.array_join(F.transform(own, lambda h: F.lower(F.lpad(F.hex(h), HASH_DIGITS, "0"))), "")


def _shared(a: Column, b: Column, whole: Column) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        F.coalesce(both / F.nullif(whole, F.lit(0)), F.lit(0.0))
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of either text that both have; two empty sketches are alike, 1."""
    return _shared(a, b, F.size(F.array_union(a, b)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shorter text's shingles that the other has; 1 for two empty sketches, 0 for one."""
    return _shared(a, b, F.least(F.size(a), F.size(b)))


def sketches(documents: DataFrame, params: SketchParams = SketchParams()) -> DataFrame:
    """``doc_id`` and ``sketch`` of every row; null and empty texts have an empty sketch.

    Repeated rows and null ids are kept each; other columns are not read. No shuffle.
    """
    return documents.select("doc_id", sketch(F.col("text"), params).alias("sketch"))


def merged(found: DataFrame, *keys: str, params: SketchParams = SketchParams()) -> DataFrame:
    """The sketches of all texts with equal ``keys`` together, as rows of the keys and a ``hash``.

    The union of a group's sketches grows with the group, so it stays a table of rows, each
    hash once; groups without words have none. Null keys are a group of their own.
    """
    rows = found.select(*keys, F.explode("sketch").alias("hash"))
    below = rows.filter(F.col("hash") < limit(params)).distinct()
    least = rows.groupBy(*keys).agg(F.min("hash").alias("hash"))
    return below.unionByName(least.filter(F.col("hash") >= limit(params)))


def contained_in(found: DataFrame, reference: DataFrame) -> DataFrame:
    """``doc_id`` and ``share``: how much of each document's sketch is among the ``hash`` rows of ``reference``.

    Documents that share nothing have 0, those with an empty sketch too. Rows with equal
    ids are taken together.
    """
    rows = found.select("doc_id", F.explode("sketch").alias("hash"))
    known = reference.select("hash").distinct().withColumn("_known", F.lit(1))
    share = rows.join(known, "hash", "left").groupBy("doc_id").agg((F.count("_known") / F.count("hash")).alias("share"))
    ids = found.select("doc_id").distinct()
    out = ids.alias("i").join(share.alias("s"), F.col("i.doc_id").eqNullSafe(F.col("s.doc_id")), "left")
    return out.select("i.doc_id", F.coalesce("share", F.lit(0.0)).alias("share"))


def _block(doc_id: Column, bounds: Column, step: int) -> Column:
    """How many of the sorted bounds lie below an id: coarse steps first, then within one; -1 for a null id."""

    def search(all_bounds: Column) -> Column:
        coarse = F.filter(
            F.sequence(F.lit(1), F.size(all_bounds), F.lit(step)), lambda k: F.element_at(all_bounds, k) < doc_id
        )
        return once(
            F.size(coarse),
            lambda c: F.when(c == 0, 0).otherwise(
                (c - 1) * step
                + F.size(F.filter(F.slice(all_bounds, (c - 1) * step + 1, F.lit(step)), lambda b: b < doc_id))
            ),
        )

    return F.when(doc_id.isNull(), -1).when(F.size(bounds) > 0, once(bounds, search)).otherwise(0)


def with_next(rows: DataFrame, carried: dict[str, Column], params: SketchParams = SketchParams()) -> DataFrame:
    """Each row with the columns ``carried``, and those of the next one by falling ``doc_id`` as ``next_<name>``; after the last comes the first.

    Rows need ``doc_id`` and ``digest``, which orders rows with one id (larger ones first);
    null ids come last. What is carried is worked out once per row. Rows are dealt to ranges of ids, so no task has them all: the
    bounds are quantiles, and the first row of each range is added to the range before it,
    for that one's last row. So every text is shuffled once.
    """
    spark = rows.sparkSession
    blocks = min(
        params.most_blocks, params.blocks_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    shares = ",".join(f"{k / blocks:.8f}" for k in range(1, blocks))
    quantiles = f"percentile_approx(doc_id, cast(split('{shares}', ',') as array<double>), {10 * blocks})"
    none = F.array().cast("array<bigint>")
    bounds = rows.agg(F.coalesce(F.expr(quantiles), none) if blocks > 1 else none).scalar()
    placed = rows.withColumn("_bounds", bounds)
    placed = placed.withColumn("_block", _block(F.col("doc_id"), F.col("_bounds"), max(1, int(blocks**0.5))))
    placed = placed.drop("_bounds")
    # one row per block: at most most_blocks + 1
    first = placed.groupBy("_block").agg(F.max(F.struct("doc_id", "digest")).alias("first"))
    falling = Window.orderBy(F.desc("_block"))
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_block").over(falling), F.min("_block").over(whole))
    ends = first.select(
        before.alias("_block"), F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    added = rows.join(F.broadcast(ends), same).select("_block", *rows.columns).dropDuplicates(["_block"])
    both = placed.withColumn("_added", F.lit(0)).unionByName(added.withColumn("_added", F.lit(1)))
    both = both.withColumns(carried)
    order = Window.partitionBy("_block").orderBy("_added", F.desc_nulls_last("doc_id"), F.desc("digest"))
    following = {f"next_{c}": F.lead(c).over(order) for c in carried}
    return both.withColumns(following).filter("_added = 0").drop("_block", "_added", "digest")


def neighbour_fingerprints(documents: DataFrame, params: SketchParams = SketchParams()) -> DataFrame:
    """The fingerprint of every text and of its edited text, and how like they and the next document's are.

    The edited text has its second half replaced by the beginning of the next document, by
    falling ``doc_id``. Null texts count as empty, null ids come last; repeated rows are
    each other's next and each give a row. With one row alone the next one is the row itself.
    Columns other than ``doc_id`` and ``text`` are not read; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text")).withColumn("digest", F.md5(F.col("text").cast("binary")))
    both = with_next(rows, {"text": F.col("text"), "sketch": sketch(F.col("text"), params)}, params)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = both.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    both = both.withColumns(
        {
            "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256),
            "edited_sketch": sketch(F.col("edited"), params),
        }
    )
    own, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(own).alias("fingerprint"),
        printed(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, following).alias("near_next"),
        containment(own, other).alias("contained_edited"),
        containment(own, following).alias("contained_next"),
    )
