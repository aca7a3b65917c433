"""Packing token sequences: full windows first, the rest by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from platewise.llm import bpe
from platewise.llm.common import raw_text, record, slices


@dataclass(frozen=True)
class PackingParams:
    window: int = 1024
    #: id put after each document
    end_id: int = 0
    #: what a document has beyond its full windows is cut into pieces of at most this length
    piece: int = 128
    #: pieces that are spread over windows together; bounds the work of one differencing
    group: int = 1600
    #: bytes of text that are tokenized together
    batch_bytes: int = 2 << 20


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Spread items over windows so that their sums are nearly equal; returns the items of each window.

    Every item starts as a partial partition with one filled window. The two partitions
    of the largest imbalance (largest sum less smallest) are merged again and again, the
    fullest windows of one meeting the emptiest of the other. Only filled windows are
    held. Ties go to the partition that was made first.
    """
    heap = [(-size, at, [(size, [at])]) for at, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap)[2]
        b = heapq.heappop(heap)[2]
        # both by falling sums: the last of one meet the last of the other, crosswise
        shared = len(a) + len(b) - windows
        if shared > 0:
            alone, met = a[: len(a) - shared], a[len(a) - shared :]
            other, partner = b[: len(b) - shared], b[len(b) - shared :]
            both = [(x + y, p + q) for (x, p), (y, q) in zip(met, reversed(partner), strict=True)]
            merged = alone + other + both
        else:
            merged = a + b
        merged.sort(key=_sum, reverse=True)
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, made, merged))
        made += 1
    return [items for _, items in heap[0][2]] if heap else []


def _sum(window: tuple[int, list[int]]) -> int:
    return window[0]


def near_equal_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items of each window, no window above ``capacity``; the window count rises until that holds."""
    count = -(-sum(sizes) // capacity)
    while count:
        found = difference(sizes, count)
        if max(sum(sizes[k] for k in items) for items in found) <= capacity:
            return found
        count += 1
    return []


class Piece(NamedTuple):
    """Ids of a document from ``start`` on; ``content`` holds them as little-endian 32-bit numbers."""

    doc_id: int | None
    start: int
    length: int
    doc_tokens: int
    content: bytes


SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def pack(
    documents: DataFrame, vocab: bpe.Vocabulary, params: PackingParams = PackingParams(), with_ids: bool = False
) -> DataFrame:
    """One row per piece of a document, and where it lies in which sequence.

    Each document is its ids and ``end_id`` (a null or empty text is ``end_id`` alone). Its
    full windows are sequences of their own, the rest is cut and packed with the rest of
    other documents of the same partition; so every task packs what it has read, without
    a shuffle, and a repeated task packs the same. Pieces wait until a group of them is
    full, so only the last group of a partition can leave a window half empty. A
    sequence's number joins the number of its partition and its own there. Repeated rows and ids are packed each by itself; other
    columns are not read. ``with_ids`` adds the ids of each piece.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        waiting: list[Piece] = []
        for batch in batches:
            for part in slices(batch, limit=params.batch_bytes):
                ids, bounds = bpe.encode(*raw_text(part.column("text")), shared.value)
                full, rest = cut(part.column("doc_id").to_pylist(), *with_end(ids, bounds, params.end_id), params)
                waiting += rest
                ready = len(waiting) - len(waiting) % params.group
                sequences = [[piece] for piece in full] + spread(waiting[:ready], params)
                waiting = waiting[ready:]
                yield placed(sequences, first, with_ids)
                first += len(sequences)
        yield placed(spread(waiting, params), first, with_ids)

    return documents.select("doc_id", "text").mapInArrow(run, _schema(with_ids))


def _schema(with_ids: bool) -> str:
    return SCHEMA + ", ids array<bigint>" * with_ids


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all documents with ``end_id`` after each."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def cut(
    docs: list[int | None], ids: np.ndarray, bounds: np.ndarray, params: PackingParams
) -> tuple[list[Piece], list[Piece]]:
    """The full windows of all documents, and the pieces of what is left of each."""
    # pieces that wait must not hold the batch they come from: each has its own bytes
    content = memoryview(ids.astype("<u4").tobytes())
    full: list[Piece] = []
    rest: list[Piece] = []
    for doc, base, n in zip(docs, bounds[:-1].tolist(), np.diff(bounds).tolist(), strict=True):
        over = n - n % params.window
        for size, begin, end, out in ((params.window, 0, over, full), (params.piece, over, n, rest)):
            for start in range(begin, end, size):
                at = base + start
                length = min(size, end - start)
                out.append(Piece(doc, start, length, n, bytes(content[4 * at : 4 * (at + length)])))
    return full, rest


def spread(pieces: list[Piece], params: PackingParams) -> list[list[Piece]]:
    """Sequences of the pieces, group by group."""
    out = []
    for first in range(0, len(pieces), params.group):
        own = pieces[first : first + params.group]
        out += [[own[k] for k in items] for items in near_equal_windows([p.length for p in own], params.window)]
    return out


def placed(sequences: list[list[Piece]], first: int, with_ids: bool) -> pa.RecordBatch:
    """The rows of sequences that are numbered from ``first``."""
    rows = [
        (piece, number, end - piece.length)
        for number, own in enumerate(sequences, first)
        for piece, end in zip(own, accumulate(p.length for p in own), strict=True)
    ]
    out: dict[str, object] = {
        "doc_id": [p.doc_id for p, _, _ in rows],
        "start": [p.start for p, _, _ in rows],
        "length": [p.length for p, _, _ in rows],
        "ids_crc32": [zlib.crc32(p.content) for p, _, _ in rows],
        "doc_tokens": [p.doc_tokens for p, _, _ in rows],
        "sequence_id": [number for _, number, _ in rows],
        "offset": [offset for _, _, offset in rows],
    }
    if with_ids:
        out["ids"] = [np.frombuffer(p.content, "<u4").tolist() for p, _, _ in rows]
    return record(_schema(with_ids), out)
