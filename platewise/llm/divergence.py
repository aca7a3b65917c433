"""Source divergence audit: how the words of each source differ from those of its language and of other sources.

Tokenizing is two passes of C code over a text's bytes: a translation table lowers A-Z and
blanks all separators, and the blanks split the rest. A counter per document gives the
frequencies, from which tasks emit sparse sums. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import record, saved, slices
from platewise.llm.words import ramp

#: ASCII letters are lowered, other ASCII bytes become blanks, bytes beyond ASCII stay
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

GROUP = ["lang", "source"]


@dataclass(frozen=True)
class DivergenceParams:
    #: documents of a language that a kept term is in, at least
    least_documents: int = 3
    #: shares are whole numbers of this fraction
    unit: int = 1_000_000_000
    #: added to every count
    smoothing: int = 1
    #: ranks of terms reported for each group
    top_terms: int = 200
    #: (group, term) sums a task gathers before it passes them on
    gathered: int = 1 << 18
    #: pairs of sources worked on at once
    pairs_at_once: int = 1 << 20


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, lowered, and of characters beyond ASCII in a text's UTF-8."""
    return text.translate(TABLE).split()


def term_counts(documents: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences in ``docs`` documents, summed per task.

    A group and term may have several rows. Null texts, languages and sources are ''.
    """
    schema = "lang string, source string, term string, n bigint, docs bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = defaultdict(lambda: (Counter(), Counter()))

        def gathered() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in sums.items():
                yield record(
                    schema,
                    {
                        "lang": [lang] * len(n),
                        "source": [source] * len(n),
                        "term": pa.array(n.keys(), pa.binary()).cast(pa.string()),
                        "n": list(n.values()),
                        "docs": [docs[t] for t in n],
                    },
                )
            sums.clear()

        held = 0
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                names = (part.column(c).to_pylist() for c in GROUP)
                for lang, source, text in zip(*names, texts, strict=True):
                    n, docs = sums[lang or "", source or ""]
                    before = len(n)
                    own = Counter(terms(text))
                    for term, times in own.items():
                        n[term] += times
                    docs.update(own.keys())
                    held += len(n) - before
                if held > params.gathered:
                    yield from gathered()
                    held = 0
        yield from gathered()

    return documents.select("lang", "source", "text").mapInArrow(run, schema)


def _share(count: str, total: str, params: DivergenceParams) -> str:
    """1 + floor(unit * (count + smoothing) / (total + smoothing * kept)), exact for any count; null if nothing is kept."""
    top = f"cast({count} + {params.smoothing} as decimal(20,0)) * cast({params.unit} as decimal(10,0))"
    return f"1 + ({top}) div nullif(cast({total} + {params.smoothing} * kept as decimal(21,0)), 0)"


def _apart(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def kept_terms(documents: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """The counts ``n`` of every group's kept terms, with the language's ``lang_n``; ``first`` marks one row per language and term.

    The tasks' sums are shuffled once, by language and term: groups, sums over groups and
    the test of the number of documents all follow from that.
    """
    sums = term_counts(documents, params).repartition("lang", "term")
    sums = sums.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    sums = sums.withColumns(
        {
            "lang_docs": F.sum("docs").over(term),
            "lang_n": F.sum("n").over(term),
            "first": F.row_number().over(term.orderBy("source")) == 1,
        }
    )
    return sums.filter(F.col("lang_docs") >= params.least_documents).select(*GROUP, "term", "n", "lang_n", "first")


def group_totals(documents: DataFrame, kept: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """Every occurring group: its ``total`` of kept terms, how many of them it ``has``, the language's ``kept`` and ``lang_total``.

    ``zero`` is the group's share of a term that it doesn't have; null where none is kept.
    """
    names = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in GROUP]).distinct()
    own = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("has"))
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("kept"), F.sum("n").alias("lang_total"))
    out = names.join(own, GROUP, "left").join(langs, "lang", "left")
    out = out.fillna(0, ["total", "has", "kept", "lang_total"])
    return out.withColumn("zero", F.expr(_share("0", "total", params)))


def term_part(kept: DataFrame, groups: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """Each group's terms that it uses more than its language, the most telling first."""
    shares = kept.join(groups, GROUP).withColumns(
        {"p": F.expr(_share("n", "total", params)), "q": F.expr(_share("lang_n", "lang_total", params))}
    )
    found = shares.filter("p > q").select(*GROUP, F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
    return _ranked(found, "term").filter(F.col("rank") <= params.top_terms)


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return found.select(*GROUP, F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _common_terms(p: np.ndarray, zero: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What a term of both groups adds beyond what the sums of each group alone count for it."""

    def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a - b) * (a - b) // b

    a, b, a0, b0 = p[left], p[right], zero[left], zero[right]
    return apart(a, b) - apart(a, b0) - apart(a0, b) + apart(a0, b0)


def pair_sums(rows: pa.Table, params: DivergenceParams) -> Iterator[dict[str, object]]:
    """Of whole terms, sorted: sums per pair of sources, worked out for a bounded number of pairs at once."""
    coded = {c: rows[c].combine_chunks().dictionary_encode() for c in ("lang", "term", "source")}
    lang, term, source = (np.asarray(coded[c].indices, dtype=np.int64) for c in ("lang", "term", "source"))
    p, zero = (rows[c].to_numpy() for c in ("p", "zero"))
    new = np.ones(len(p), bool)
    new[1:] = (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(p)))
    start, partners = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    at = np.flatnonzero(partners > 1)
    cuts = np.cumsum(partners[at]) // params.pairs_at_once
    n = len(coded["source"].dictionary)
    for some in np.split(at, np.flatnonzero(np.diff(cuts)) + 1):
        if not len(some):
            continue
        left = np.repeat(some, partners[some])
        right = np.repeat(start[some], partners[some]) + ramp(partners[some])
        left, right = left[left != right], right[left != right]
        key = (lang[left] * n + source[left]) * n + source[right]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        pair = key[first]
        names = coded["source"].dictionary
        yield {
            "lang": coded["lang"].dictionary.take(pa.array(pair // (n * n))),
            "source": names.take(pa.array(pair // n % n)),
            "item": names.take(pa.array(pair % n)),
            "value": np.add.reduceat(_common_terms(p, zero, left, right)[order], first),
        }


def pair_part(kept: DataFrame, groups: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """How far each other source of a language is, summed over all kept terms.

    Most terms are missing in most sources, so the sum is put together from sparse parts:
    for terms of one source the other's share is a constant, and equal counts of a source
    are equal shares, so a histogram of its counts is enough; only terms that two sources
    have in common are looked at by pair. These lie together after a shuffle by term, and a
    task passes on sums per pair.
    """
    schema = "lang string, source string, item string, value bigint"
    shares = kept.join(groups, GROUP).select(*GROUP, "term", F.expr(_share("n", "total", params)).alias("p"), "zero")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed_on(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for sums in pair_sums(rows, params):
                yield record(schema, sums)

        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            # the last term may go on in the next batch
            last = [rows[c][-1].as_py() for c in ("lang", "term")]
            cut = rows.num_rows - 1
            while cut and [rows[c][cut - 1].as_py() for c in ("lang", "term")] == last:
                cut -= 1
            yield from passed_on(rows.slice(0, cut))
            rest = rows.slice(cut)
        if rest is not None:
            yield from passed_on(rest)

    ordered = shares.repartition("lang", "term").sortWithinPartitions("lang", "term")
    common = ordered.mapInArrow(run, schema)

    # a language's pairs are dealt out by a number besides, so that it is not one task
    parts = 32
    one = groups.select(*GROUP, "has", "zero", "kept", F.pmod(F.xxhash64("source"), F.lit(parts)).alias("_part"))
    other = groups.select(
        "lang",
        F.col("source").alias("item"),
        F.col("has").alias("item_has"),
        F.col("zero").alias("item_zero"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("_part"),
    )
    pairs = one.join(other, ["lang", "_part"]).filter("source <> item")
    pair = [*GROUP, "item"]
    in_none = f"(kept - has - item_has) * ({_apart('zero', 'item_zero')})"
    counts = kept.groupBy(*GROUP, "n").agg(F.count(F.lit(1)).alias("times"))
    counts = counts.join(groups.select(*GROUP, "total", "kept"), GROUP)
    counts = counts.select(*GROUP, "times", F.expr(_share("n", "total", params)).alias("p"))
    of_source = pairs.join(counts, GROUP).select(*pair, F.expr(f"times * ({_apart('p', 'item_zero')})").alias("value"))
    of_item = pairs.join(counts.withColumnRenamed("source", "item"), ["lang", "item"])
    of_item = of_item.select(*pair, F.expr(f"times * ({_apart('zero', 'p')})").alias("value"))
    parts_of_sum = pairs.select(*pair, F.expr(in_none).alias("value"))
    for more in (of_source, of_item, common):
        parts_of_sum = parts_of_sum.unionByName(more)
    sums = parts_of_sum.groupBy(*pair).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value"))
    return _ranked(sums, "pair")


def audit(documents: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """Both parts: ``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Null texts, languages and sources count as ''. Repeated rows are documents of their
    own. A language without kept terms has distances 0 and no terms, an empty table no
    rows. Columns other than ``text``, ``lang`` and ``source`` are not read. Counts of kept
    terms and of groups are written to the work folder once.
    """
    kept = saved(kept_terms(documents, params), "kept-terms")
    groups = saved(group_totals(documents, kept, params), "groups")
    return pair_part(kept, groups, params).unionByName(term_part(kept, groups, params))
