"""Byte-level BPE: encode and decode whole batches of texts by contiguous arrays of ranks.

A batch is cut into words on its bytes, equal words are encoded once. For a word the parts
between its boundaries and the ranks of adjacent parts lie in two contiguous arrays. The
least rank is looked up by a scan, the boundary at it is deleted, and the two ranks beside
it are computed anew, until no adjacent pair has a rank. Many words of similar length go
through these steps together, one row of a matrix each. Longer words, for which a scan per
merge would be quadratic, keep their pairs on a heap.
"""

from __future__ import annotations

import heapq
import json
import re
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import regex

from platewise.llm.words import LEADS, hash_runs, ramp

#: words of more bytes are merged one by one, by a heap of their pairs
SHORT_BYTES = 32
NO_RANK = np.int32(2**31 - 1)
_SLOT_BITS = 18

# Classes of characters for cutting words.
OTHER, LETTER, NUMBER, SPACE = range(4)
#: fixed endings after an apostrophe that are words of their own
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def character_classes() -> np.ndarray:
    """The class of every code point: white space, letter, number or none of these."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            shift = [0 if k < 0xD800 else 0x800 for k in (m.start(), m.end() - 1)]
            classes[m.start() + shift[0] : m.end() + shift[1]] = kind
    return classes


@dataclass
class Known:
    """Words by sorted hash with their ids; emptied when it holds ``limit`` words, so memory stays bounded."""

    limit: int = 1_000_000
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    firsts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def add(self, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Take in new words, in order of their hashes."""
        if len(self.hashes) + len(hashes) > self.limit:
            fresh = Known(self.limit)
            self.hashes, self.firsts, self.counts, self.ids = fresh.hashes, fresh.firsts, fresh.counts, fresh.ids
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.firsts = np.insert(self.firsts, at, np.cumsum(counts) - counts + len(self.ids))
        self.counts = np.insert(self.counts, at, counts)
        self.ids = np.concatenate([self.ids, ids])


@dataclass
class Vocabulary:
    """Tables of one tokenizer; of a fixed size, to be broadcast."""

    #: id of each byte, bytes of each id
    byte_ids: np.ndarray
    pieces: list[bytes]
    #: the merges by rank: keys ``left id << 32 | right id`` and the merged ids
    keys: np.ndarray
    merged: np.ndarray
    #: texts that are one token of their own wherever they occur
    special: dict[bytes, int]
    classes: np.ndarray
    piece_sizes: np.ndarray = field(init=False)
    piece_starts: np.ndarray = field(init=False)
    piece_bytes: np.ndarray = field(init=False)
    #: hash table with linear probing: rank or NO_RANK
    slots: np.ndarray = field(init=False)
    #: words met so far
    known: Known = field(init=False)

    @cached_property
    def pair_ranks(self) -> dict[int, int]:
        """The rank of each key, for single look-ups; made where the first long word is met."""
        return {key: rank for rank, key in enumerate(self.keys.tolist())}

    def __post_init__(self) -> None:
        self.known = Known()
        self.slots = np.full(1 << _SLOT_BITS, NO_RANK, np.int32)
        for rank, at in enumerate(_slot(self.keys).tolist()):
            while self.slots[at] != NO_RANK:
                at = (at + 1) % len(self.slots)
            self.slots[at] = rank
        self.piece_sizes = np.array([len(p) for p in self.pieces], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(self.pieces), np.uint8)


def load(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library. Files with other steps are refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
        raise ValueError(f"{path} isn't a plain byte-level BPE")
    symbols = byte_symbols()
    vocab = model["vocab"]
    special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
    pieces = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for text, at in vocab.items():
        pieces[at] = bytes(symbols[c] for c in text)
    for text, at in special.items():
        pieces[at] = text
    byte_ids = np.zeros(256, np.int32)
    for c, b in symbols.items():
        byte_ids[b] = vocab[c]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
    return Vocabulary(byte_ids, pieces, keys, merged, special, character_classes())


def _slot(key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _rank(left: np.ndarray, right: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """The rank of each adjacent pair, or NO_RANK."""
    shape, key = left.shape, (left.astype(np.int64) << 32 | right).ravel()
    at = _slot(key)
    rank = vocab.slots[at]
    # empty slots and hits end the search
    todo = np.flatnonzero((rank != NO_RANK) & (vocab.keys[np.minimum(rank, len(vocab.keys) - 1)] != key))
    while len(todo):
        at[todo] = (at[todo] + 1) % len(vocab.slots)
        rank[todo] = vocab.slots[at[todo]]
        todo = todo[(rank[todo] != NO_RANK) & (vocab.keys[np.minimum(rank[todo], len(vocab.keys) - 1)] != key[todo])]
    return rank.reshape(shape)


def merge_rows(parts: np.ndarray, sizes: np.ndarray, vocab: Vocabulary) -> None:
    """Merge the parts of every row in place; row ``i`` has ``sizes[i]`` parts, which shrinks as they merge."""
    width = parts.shape[1]
    if width < 2:
        return
    column = np.arange(width - 1)
    ranks = _rank(parts[:, :-1], parts[:, 1:], vocab)
    ranks[column >= (sizes - 1)[:, None]] = NO_RANK
    rows = np.arange(len(parts))
    while len(rows):
        own = ranks[rows]
        at = own.argmin(axis=1)
        least = own[np.arange(len(rows)), at]
        going = least < NO_RANK
        rows, at, least = rows[going], at[going], least[going]
        if not len(rows):
            return
        # delete the boundary after part ``at``: what is right of it moves one place left
        moved = parts[rows]
        moved[:, :-1] = np.where(column >= (at + 1)[:, None], moved[:, 1:], moved[:, :-1])
        moved[np.arange(len(rows)), at] = vocab.merged[least]
        parts[rows] = moved
        sizes[rows] -= 1
        own = own[going]
        own[:, :-1] = np.where(column[:-1] >= at[:, None], own[:, 1:], own[:, :-1])
        own[:, -1] = NO_RANK
        each, n = np.arange(len(rows)), sizes[rows]
        for k in (at - 1, at):
            ok = (k >= 0) & (k < n - 1)
            i, j = each[ok], k[ok]
            own[i, j] = _rank(moved[i, j], moved[i, j + 1], vocab)
        ranks[rows] = own


def merge_long(parts: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Merge one long word by a heap of its adjacent pairs, least rank first, then from the left.

    The parts are linked to their neighbours. A merge puts the two pairs it makes on the heap;
    entries of pairs that are gone are known by their rank. So the steps grow with the length
    of the word, but for the heap's logarithm.
    """
    n = len(parts)
    if n < 2:
        return parts
    merged, known = vocab.merged.tolist(), vocab.pair_ranks
    own = parts.tolist()
    first = _rank(parts[:-1], parts[1:], vocab)
    # the rank of the pair that starts at each part; -1 where there is none
    rank = np.append(np.where(first == NO_RANK, -1, first), -1).tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    at = np.flatnonzero(first != NO_RANK)
    # rank and place in one number
    heap = (first[at].astype(np.int64) << 32 | at).tolist()
    heapq.heapify(heap)
    while heap:
        least = heapq.heappop(heap)
        i = least & 0xFFFFFFFF
        if rank[i] != least >> 32:
            continue
        own[i] = merged[rank[i]]
        gone = after[i]
        own[gone], rank[gone] = -1, -1
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        for left in (before[i], i):
            if left < 0:
                continue
            right = after[left]
            rank[left] = known.get(own[left] << 32 | own[right], -1) if right < n else -1
            if rank[left] >= 0:
                heapq.heappush(heap, rank[left] << 32 | left)
    out = np.array(own, np.int32)
    return out[out >= 0]


def cut(data: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in the bytes of all texts, and the id of each word that is a special token, else -1."""
    special = sorted(
        (m.start(), m.end(), at) for text, at in vocab.special.items() for m in re.finditer(re.escape(text), data.tobytes())
    )
    # a special token within one text parts it
    special = [s for s in special if bounds[np.searchsorted(bounds, s[0], side="right")] >= s[1]]
    if special:
        bounds = np.unique(np.concatenate([bounds, *([[s[0], s[1]] for s in special])]))
    leads = np.flatnonzero(LEADS[data])
    kind = vocab.classes[_code_points(data, leads)]
    n = len(leads)
    opens = np.zeros(n + 1, bool)
    opens[np.searchsorted(leads, bounds)] = True
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= opens[:-1]
    # the last of several blanks before something else parts from the others; a plain one joins what follows
    before = np.flatnonzero(start[1:] & ~opens[1:-1] & (kind[:-1] == SPACE))
    start[before] = True
    start[before + 1] = data[leads[before]] != 0x20
    # an apostrophe that starts a word, with one of the fixed endings
    quote = np.flatnonzero(start & (data[leads] == 0x27))
    closes = bounds[np.minimum(np.searchsorted(bounds, leads[quote], side="right"), len(bounds) - 1)] if n else quote
    for ending in ENDINGS:
        fits = leads[quote] + 1 + len(ending) <= closes
        for k, c in enumerate(ending):
            place = np.minimum(leads[quote] + 1 + k, len(data) - 1)
            fits &= data[place] == c
        q = quote[fits]
        start[q + 1] = False
        after = q + 1 + len(ending)
        start[after[after < n]] = True
    starts = leads[start]
    ids = np.full(len(starts), -1, np.int64)
    if special:
        inside = np.zeros(len(data), bool)
        for s, e, _ in special:
            inside[s + 1 : e] = True
        starts = starts[~inside[starts]]
        ids = np.full(len(starts), -1, np.int64)
        for s, _, at in special:
            ids[np.searchsorted(starts, s)] = at
    return starts, ids


def _code_points(data: np.ndarray, leads: np.ndarray) -> np.ndarray:
    first = data[leads].astype(np.int32)
    points = first.copy()
    wide = np.flatnonzero(first >= 0x80)
    if len(wide):
        at, lead = leads[wide], first[wide]
        byte = [(data[np.minimum(at + k, len(data) - 1)] & 0x3F).astype(np.int32) for k in range(4)]
        two = (lead & 0x1F) << 6 | byte[1]
        three = (lead & 0x0F) << 12 | byte[1] << 6 | byte[2]
        four = (lead & 0x07) << 18 | byte[1] << 12 | byte[2] << 6 | byte[3]
        points[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    return points


def _encode_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, vocab: Vocabulary):
    """Ids of distinct words, one after another, and how many each has."""
    counts = np.zeros(len(starts), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    low = 0
    for high in (2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, SHORT_BYTES):
        at = np.flatnonzero((sizes > low) & (sizes <= high))
        low = high
        if not len(at):
            continue
        n = sizes[at].copy()
        place = starts[at][:, None] + np.minimum(np.arange(high), (n - 1)[:, None])
        parts = vocab.byte_ids[data[place]]
        merge_rows(parts, n, vocab)
        counts[at] = n
        found.append((at, parts[np.arange(high) < n[:, None]]))
    for k in np.flatnonzero(sizes > SHORT_BYTES):
        ids = merge_long(vocab.byte_ids[data[starts[k] : starts[k] + sizes[k]]], vocab)
        counts[k] = len(ids)
        found.append((np.array([k]), ids))
    firsts = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), np.int32)
    for at, own in found:
        ids[np.repeat(firsts[at], counts[at]) + ramp(counts[at])] = own
    return ids, counts


def encode(data: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, and the bounds of each text among them.

    ``data`` holds the UTF-8 bytes of the texts one after another, ``bounds`` where each
    starts and, last, the end.
    """
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    starts, fixed = cut(data, bounds, vocab)
    sizes = np.diff(np.append(starts, len(data)))
    hashes = hash_runs(data, sizes)
    distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    known = vocab.known
    at = np.searchsorted(known.hashes, distinct)
    new = np.ones(len(distinct), bool)
    old = at < len(known.hashes)
    new[old] = known.hashes[at[old]] != distinct[old]
    if new.any():
        ids, counts = _encode_words(data, starts[first[new]], sizes[first[new]], vocab)
        if len(known.hashes) + new.sum() > known.limit:
            # the store is emptied: all words of this batch have to be in it
            ids, counts = _encode_words(data, starts[first], sizes[first], vocab)
            known.add(distinct, counts, ids)
        else:
            known.add(distinct[new], counts, ids)
    at = np.searchsorted(known.hashes, distinct)[which]
    per_word = np.where(fixed >= 0, 1, known.counts[at])
    out = known.ids[np.repeat(known.firsts[at], per_word) + ramp(per_word)]
    ends = np.concatenate([[0], np.cumsum(per_word)])
    if (fixed >= 0).any():
        out[ends[:-1][fixed >= 0]] = fixed[fixed >= 0]
    return out, ends[np.searchsorted(starts, bounds)]


def decode(ids: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text's tokens, and the bounds of each text among them; special tokens are spelt out."""
    sizes = vocab.piece_sizes[ids]
    content = vocab.piece_bytes[np.repeat(vocab.piece_starts[ids], sizes) + ramp(sizes)]
    return content, np.concatenate([[0], np.cumsum(sizes)])[bounds]
