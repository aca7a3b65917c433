"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import fold, map_text, record, slices
from platewise.operators.dedup import top_per_key

UNKNOWN = "und"
# also numbers that aren't decimal digits, as superscripts
_PERHAPS_LETTER = re.compile(r"[^\W\d_]")
#: between texts and in place of white space: no n-gram counts across texts
_GAP = "\x00"


@dataclass(frozen=True)
class LanguageParams:
    sizes: tuple[int, ...] = (1, 2, 3)
    #: buckets of hashed n-grams, a power of two
    bits: int = 15
    #: added to every count
    smoothing: float = 0.5
    #: documents of each language that are learnt from, those with the smallest hashes of their ids
    sample_rows: int = 8000
    #: folds of crc32(doc_id), and the one that is never learnt from
    folds: int = 4
    held: int = 2


@dataclass(frozen=True)
class LanguageModel:
    """``log_likelihood[language, bucket]``; languages in order of their names."""

    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_likelihood: np.ndarray
    params: LanguageParams


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _PERHAPS_LETTER.finditer(text))


def _grams(texts: list[str], params: LanguageParams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size the buckets of all n-grams, and the bounds of each text among them."""
    low = [" ".join(t.lower().split()) for t in texts]
    sizes = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    joined = _GAP.join(low) + _GAP
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    inside = points != 0
    h = np.zeros(len(points), np.uint32)
    for n in range(1, max(params.sizes) + 1):
        m = len(points) - n + 1
        if m <= 0:
            return
        with np.errstate(over="ignore"):
            h = (h[:m] + points[n - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        if n in params.sizes:
            bucket = ((h * np.uint32(0x85EBCA77)) >> np.uint32(32 - params.bits)).astype(np.int32)
            ok = inside[:m] & inside[n - 1 :]
            for k in range(1, n - 1):
                ok &= inside[k : k + m]
            at = np.flatnonzero(ok)
            yield bucket[at], np.searchsorted(at, bounds)


def train(documents: DataFrame, params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Count n-grams per language over a bounded sample outside the held-out fold.

    Counting runs in tasks; the driver receives one array of ``2 ** bits`` counts per language.
    Null and blank languages and null ids are not learnt from; a null text has no n-grams.
    """
    known = documents.select("doc_id", "lang").filter(
        (F.trim("lang") != "") & (fold("doc_id", params.folds) != params.held)
    )
    # a language may hold most of the rows: its first rows are taken per part of the input before they meet
    chosen = top_per_key(known, ["lang"], [F.xxhash64("doc_id"), F.col("doc_id")], params.sample_rows)
    # at most sample_rows ids of each language: a bounded side
    ids = F.broadcast(chosen.select("doc_id").distinct())
    sample = documents.select("doc_id", "lang", "text").filter(F.trim("lang") != "").join(ids, "doc_id", "left_semi")
    size = 1 << params.bits
    found = sorted(_counted(sample.select("lang", "text"), params, size).collect())
    languages = [lang for lang, _, _ in found]
    counts = np.array([np.frombuffer(data, np.int64) for _, _, data in found], float).reshape(-1, size)
    docs = np.array([n for _, n, _ in found], float)
    total = counts + params.smoothing
    likelihood = np.log(total / total.sum(axis=1, keepdims=True))
    prior = np.log(docs / max(docs.sum(), 1))
    return LanguageModel(tuple(languages), prior, likelihood.astype(np.float32), params)


def _counted(sample: DataFrame, params: LanguageParams, size: int) -> DataFrame:
    """(lang, n documents, counts as 64-bit integers), one row per language."""
    schema = "lang string, n bigint, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                texts = np.array(part.column("text").to_pylist(), object)
                langs = np.array(part.column("lang").to_pylist(), object)
                for lang in set(langs):
                    own = totals.setdefault(lang, np.zeros(size, np.int64))
                    docs[lang] = docs.get(lang, 0) + int((langs == lang).sum())
                    for bucket, _ in _grams(texts[langs == lang].tolist(), params):
                        own += np.bincount(bucket, minlength=size)
        names = list(totals)
        yield record(
            schema,
            {"lang": names, "n": [docs[x] for x in names], "counts": [totals[x].tobytes() for x in names]},
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        n = sum(table.column("n").to_pylist())
        values = {"lang": [table.column("lang")[0].as_py()], "n": [n], "counts": [total.tobytes()]}
        return pa.Table.from_batches([record(schema, values)])

    return sample.mapInArrow(count, schema).groupBy("lang").applyInArrow(add, schema)


def scores(texts: list[str], model: LanguageModel) -> np.ndarray:
    """Log of the joint probability, a row per text and a column per language."""
    total = np.tile(model.log_prior, (len(texts), 1))
    for bucket, bounds in _grams(texts, model.params):
        for k in range(len(model.languages)):
            values = np.take(model.log_likelihood[k], bucket)
            # sums between bounds; texts without n-grams add nothing
            sums = np.add.reduceat(np.append(values, np.float32(0)), np.minimum(bounds[:-1], len(values)), dtype=float)
            total[:, k] += np.where(np.diff(bounds) > 0, sums, 0.0)
    return total


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``, the posterior probability of the prediction.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text
    if nothing could be learnt. Ties go to the first language by name. A null id has a
    null fold and counts as not held out. Repeated rows are looked at each by itself, an
    empty table gives no rows, columns other than ``doc_id`` and ``text`` are not read. The
    model has a fixed size per language and is broadcast.
    """
    params = model.params
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> dict[str, object]:
        own = shared.value
        texts = part.column("text").to_pylist()
        known = [k for k, t in enumerate(texts) if own.languages and has_letter(t)]
        names, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            total = scores([texts[k] for k in known], own)
            best = total.argmax(axis=1)
            share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            for k, b, s in zip(known, best.tolist(), share.tolist(), strict=True):
                names[k], sure[k] = own.languages[b], s
        return {"doc_id": part.column("doc_id"), "lang_pred": names, "score": sure}

    out = map_text(documents, ["doc_id"], work, "doc_id bigint, lang_pred string, score double")
    held = F.coalesce(fold("doc_id", params.folds) == params.held, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
