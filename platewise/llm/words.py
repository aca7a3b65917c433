"""Words, lines and their hashes on UTF-8 bytes, for whole batches of texts at once.

A word is a run of bytes other than blank and 0x09 to 0x0D. Bytes of a UTF-8 sequence are
never among those, so words on bytes are words on characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RANDOM = np.random.default_rng(20240229)
#: a random number per byte value, and odd multipliers by position
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
PLACES = _RANDOM.integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LEADS = (np.arange(256) & 0xC0) != 0x80

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd constant, modulo 2 to the 64."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 1024), STEP))])
    return _powers[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the given lengths."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) - np.repeat(first, lengths)


#: runs hashed at once: what they take beside the result is bounded
HASHED_AT_ONCE = 1 << 17


def hash_runs(content: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``content``, which holds the runs one after another; none is empty."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    if len(lengths) > HASHED_AT_ONCE:
        cuts = np.arange(0, len(lengths), HASHED_AT_ONCE)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return np.concatenate(
            [
                hash_runs(content[ends[k] : ends[min(k + HASHED_AT_ONCE, len(lengths))]], lengths[k : k + HASHED_AT_ONCE])
                for k in cuts.tolist()
            ]
        )
    with np.errstate(over="ignore"):
        values = BYTE_VALUES[content] * powers(int(lengths.max()))[ramp(lengths)]
        sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mixed(sums)


@dataclass
class Runs:
    """Runs of bytes: where each starts and ends, and the first run of each text (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.per_text)


def runs(inside: np.ndarray, bounds: np.ndarray) -> Runs:
    """Runs of true values, none across a text's bounds."""
    n = len(inside)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return Runs(starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, bounds))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[Runs, np.ndarray]:
    """The words, and which bytes are inside one."""
    inside = ~BLANK[data]
    return runs(inside, bounds), inside


def count_between(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many true values lie between consecutive bounds."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), bounds))


def count_in(mask: np.ndarray, spans: Runs) -> np.ndarray:
    """How many true values lie in each run."""
    at = np.flatnonzero(mask)
    return np.searchsorted(at, spans.ends) - np.searchsorted(at, spans.starts)


def windows(hashes: np.ndarray, found: Runs, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every window of ``size`` words within one text, and the word at which each begins."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = hashes[:n] * PLACES[0]
        for k in range(1, size):
            total += hashes[k : k + n] * PLACES[k]
    at = np.arange(n)
    keep = at + size <= np.repeat(found.first[1:], found.per_text)[:n]
    return mixed(total[keep]), at[keep]
