"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart, the shorter one (or either, of equal length) is cut into two
disjoint chunks, halves that cover it. The edit falls into one of them; the other stands
whole in the longer word, at its own place or one further. So the chunks of one word and
the positional grams of the other are joined, and what they bring together is verified.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from platewise.llm.common import record, saved, slices


@dataclass(frozen=True)
class SpellingParams:
    #: code points of a word, and occurrences, at least
    least_length: int = 5
    least_count: int = 3
    #: of so many (document, run) one loses a code point
    thinned: int = 97
    #: how many times as frequent a form is as its variant, at least
    ratio: int = 2
    #: words a task counts before it passes them on
    gathered: int = 1 << 18


_ASCII_LOW = {c: c + 32 for c in range(65, 91)}


def low(run: str) -> str:
    """The run with A-Z lowered, and nothing else."""
    return run.lower() if run.isascii() else run.translate(_ASCII_LOW)


def words_of(doc_id: int | None, text: str, runs: re.Pattern, params: SpellingParams) -> Iterator[tuple[str, int]]:
    """A text's words with their counts: its runs, lowered; those whose checksum the divisor divides lose a code point."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs.findall(text)).items():
        word = low(run)
        h = zlib.crc32(word.encode(), start)
        if h % params.thinned == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        if len(word) >= params.least_length:
            yield word, n


def count_words(documents: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """``word`` and ``n``, how often it occurs in all texts, of words frequent and long enough.

    Tasks add up what they see before the shuffle. A null id counts as the empty text.
    """
    schema = "word string, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a shorter run gives no word, and greedy matches are whole runs
        runs = re.compile(rf"[A-Za-zÀ-ÿ]{{{params.least_length},}}")
        sums: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
                for doc_id, text in zip(ids, texts, strict=True):
                    for word, n in words_of(doc_id, text, runs, params):
                        sums[word] += n
                if len(sums) > params.gathered:
                    yield record(schema, {"word": list(sums), "n": list(sums.values())})
                    sums.clear()
        yield record(schema, {"word": list(sums), "n": list(sums.values())})

    sums = documents.select("doc_id", "text").mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return sums.filter(F.col("n") >= params.least_count)


def _grams(length: Column) -> list[Column]:
    """Structs (``length``, ``place``, ``gram``) of a word, as long as ``length`` or one longer, seen from words of ``length``.

    The word's two halves, for a word of just ``length``: the first stands at the beginning
    and the second at the end, so with one code point more that one is a place further. An
    edit leaves one half whole and falls into the other, of which one half is whole again:
    each gram is a half and a quarter, so frequent halves don't bring all their words together.
    """
    size = F.length("word")
    half = F.floor(length / 2).cast("int")
    tail = (length - half).cast("int")
    parts = [
        (F.substring("word", 1, half), F.substring("word", half + 1, size - half), tail),
        (F.substring("word", size - tail + 1, tail), F.substring("word", 1, size - tail), half),
    ]
    found = []
    for whole, rest, wanted in parts:
        first = F.floor(wanted / 2).cast("int")
        last = (wanted - first).cast("int")
        found += [
            F.concat(whole, F.lit(" "), F.substring(rest, 1, first)),
            F.concat(whole, F.lit(" "), F.substring(rest, F.length(rest) - last + 1, last)),
        ]
    return [F.struct(length.alias("length"), F.lit(k).alias("place"), g.alias("gram")) for k, g in enumerate(found)]


def chunks(words: DataFrame) -> DataFrame:
    """A word's own two disjoint chunks, each with a half of what the other one covers."""
    return words.select("word", "n", F.inline(F.array(*_grams(F.length("word")))))


def grams(words: DataFrame) -> DataFrame:
    """The positional grams of a word that the chunks of a word as long, or one shorter, can equal after one edit.

    Grams at other places meet no chunk within that shift, so they are not made.
    """
    size = F.length("word")
    return words.select("word", "n", F.inline(F.array(*_grams(size), *_grams(size - 1))))


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``other`` and the other's count ``n`` for every two words one edit apart, both ways.

    Words meet where length, place and gram agree, and are verified in the join, so what
    merely shares a gram is never written. Frequent grams are left to the skew handling of
    the sort-merge join. Spark sizes the chunks as their words' compressed file, so without
    a hint it would send them through the driver.
    """
    one = chunks(words).alias("c")
    two = grams(words).alias("g")
    same = [F.col(f"c.{k}") == F.col(f"g.{k}") for k in ("length", "place", "gram")]
    # of two words of one length the smaller is cut
    once_each = (F.length("g.word") > F.col("c.length")) | (F.col("c.word") < F.col("g.word"))
    verified = F.levenshtein("c.word", "g.word", 1) == 1
    met = one.join(two.hint("merge"), [*same, once_each, verified])
    pairs = met.select(
        F.col("c.word").alias("a"), F.col("c.n").alias("n_a"), F.col("g.word").alias("b"), F.col("g.n").alias("n_b")
    ).distinct()
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n")),
    )
    return pairs.select(F.inline(both))


def roots(forms: DataFrame, largest: int) -> DataFrame:
    """``word`` and ``root``, the last of the forms that follow from it, for rows of ``word`` and ``form``.

    A form is at least twice as frequent, so a chain has no more steps than ``largest``, the
    highest count, has halvings. Every round doubles the steps taken and is written. No side
    of a join goes through the driver, however small its files are.
    """
    found = saved(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(max(2.0, math.log2(max(2, largest)))))):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        found = saved(
            found.join(further.hint("merge"), "root", "left").select("word", F.coalesce("_further", "root").alias("root")), "roots"
        )
    return found


def spelling_variants(documents: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """Each word with its ``form`` and ``root``, its count ``n``, the number of near words and the form's count.

    Null texts have no words; a null id counts as the empty text; repeated rows count each;
    other columns are not read. A text or table without words gives no rows.
    """
    words = saved(count_words(documents, params), "words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "other")).alias("best")
    )
    better = -F.col("best.less") >= params.ratio * F.col("n")
    found = words.join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(better, F.col("best.other")).alias("form"),
        F.when(better, -F.col("best.less")).alias("form_n"),
    )
    found = saved(found, "forms")
    # one number: the highest count
    largest = words.agg(F.max("n")).first()[0] or 0
    last = roots(found.filter("form IS NOT NULL"), largest)
    return found.join(last.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
