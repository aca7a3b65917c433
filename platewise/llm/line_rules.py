"""Quality rules, line first: drop failing lines, then documents that lose too much text.

Counting runs on the bytes of whole batches (words, lines and word windows as 64-bit
hashes); only lines that hold a cue of boilerplate are looked at one by one.

A line fails as a duplicate of an earlier one; as many words without a mark of sentences; as
navigation, by its bars, its links or as part of a menu of short lines; as a short line that
comes again and again; by shouting; by symbols; or by a phrase of boilerplate in one of
several languages.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from platewise.llm.common import map_text, raw_text
from platewise.llm.words import (
    LEADS,
    LOWER,
    Runs,
    count_between,
    count_in,
    hash_runs,
    mixed,
    runs,
    windows,
    words,
)

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), list(range(65, 91)))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_SENTENCE = np.isin(np.arange(256), list(b".!?;:"))

#: phrases of boilerplate, lower case
BOILERPLATE = tuple(
    phrase.encode()
    for phrase in (
        "all rights reserved",
        "cookie policy",
        "privacy policy",
        "terms of service",
        "terms of use",
        "subscribe to our",
        "click here",
        "enable javascript",
        "lorem ipsum",
        "copyright (c)",
        "alle rechte vorbehalten",
        "alle rechten voorbehouden",
        "tous droits réservés",
        "mentions légales",
        "politique de confidentialité",
        "todos los derechos reservados",
        "política de privacidad",
        "todos os direitos reservados",
        "política de privacidade",
        "tutti i diritti riservati",
    )
)

#: how a link begins
LINKS = (b"http://", b"https://", b"www.")
#: marks between the entries of a menu; an opening quotation mark takes back its closing one
BARS = ("|", "·", "•", "→", "›", "»")
OPENING = ("‹", "«")


@dataclass(frozen=True)
class LineRules:
    """Thresholds. A line's shares are of its words or of its characters in words."""

    min_words: int = 50
    #: words in repeated windows of three words, per hundred words
    max_repeat_percent: int = 50
    #: words at least for the rules on punctuation, navigation, shouting and symbols
    min_line_words: int = 3
    #: a line of so many words has a mark that ends or parts sentences
    max_words_unmarked: int = 12
    max_bar_share: float = 0.25
    max_link_share: float = 0.5
    #: a menu is so many lines or more, one after another, of few words and without a mark of sentences
    min_menu_lines: int = 5
    max_menu_words: int = 3
    #: a line of few words that stands in a text so often goes, the first one too
    min_short_copies: int = 3
    max_short_words: int = 5
    max_shout_share: float = 0.5
    max_upper_share: float = 0.6
    max_symbol_share: float = 0.1
    #: a document goes if its removed lines hold more than this share of its characters in words
    max_lost_share: float = 0.5


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, n_removed_lines bigint, "
    "removed_chars bigint"
)


def clean_lines(documents: DataFrame, rules: LineRules = LineRules(), with_text: bool = True) -> DataFrame:
    """One row per document: counts, the verdict and, ``with_text``, the text without its failing lines.

    A null text counts as empty. A text without words fails the base rules, is not kept
    and stays as it is. Repeated rows and ids are judged each by itself; a null id stays
    null. Other columns of ``documents`` are not read.
    """
    schema = SCHEMA + ", clean_text string" * with_text
    return map_text(documents, ["doc_id"], lambda part: judge(part, rules, with_text), schema)


def judge(part: pa.RecordBatch, rules: LineRules, with_text: bool) -> dict[str, object]:
    data, bounds = raw_text(part.column("text"))
    found, inside = words(data, bounds)
    n_words = found.per_text
    hashes = hash_runs(data[inside], found.ends - found.starts)
    word_chars = count_between(inside & LEADS[data], bounds)
    repeat = _repeated_words(hashes, found)
    base = (n_words < rules.min_words) | (100 * repeat > rules.max_repeat_percent * n_words)

    lines = runs(data != 0x0A, bounds)
    with_words, duplicate, copies = _duplicate_lines(data, inside, lines)
    failed = with_words & (duplicate | _line_fails(data, inside, found, lines, with_words, copies, rules))
    edges = np.concatenate([[0], np.cumsum(count_in(inside & LEADS[data], lines) * failed)])
    removed = edges[lines.first[1:]] - edges[lines.first[:-1]]
    out = {
        "doc_id": part.column("doc_id"),
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": count_between(_SYMBOL[data], bounds),
        "n_dup_lines": count_between(duplicate, lines.first),
        "n_repeat_words": repeat,
        "base_failed": base,
        "kept": ~base & (removed <= rules.max_lost_share * word_chars),
        "n_lines": count_between(with_words, lines.first),
        "n_removed_lines": count_between(failed, lines.first),
        "removed_chars": removed,
    }
    if with_text:
        out["clean_text"] = _without(data, bounds, lines, failed)
    return out


def _repeated_words(hashes: np.ndarray, found: Runs) -> np.ndarray:
    """Per text, the words that lie in a window of three words found twice or more in it."""
    window, at = windows(hashes, found, 3)
    marked = np.zeros(len(hashes), bool)
    if len(window):
        with np.errstate(over="ignore"):
            own = mixed(window + found.text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, which, times = np.unique(own, return_inverse=True, return_counts=True)
        twice = at[times[which] > 1]
        for k in range(3):
            marked[twice + k] = True
    return count_between(marked, found.first)


def _duplicate_lines(
    data: np.ndarray, inside: np.ndarray, lines: Runs
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which lines hold a word, which of these equal an earlier one of their text, and how many equal each."""
    with_words = count_in(inside, lines) > 0
    hashes = hash_runs(data[data != 0x0A], lines.ends - lines.starts)
    with np.errstate(over="ignore"):
        own = mixed(hashes + lines.text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(with_words)
    _, first, which, times = np.unique(own[at], return_index=True, return_inverse=True, return_counts=True)
    duplicate = with_words.copy()
    duplicate[at[first]] = False
    copies = np.zeros(len(lines.starts), np.int64)
    copies[at] = times[which]
    return with_words, duplicate, copies


def _line_fails(
    data: np.ndarray,
    inside: np.ndarray,
    found: Runs,
    lines: Runs,
    with_words: np.ndarray,
    copies: np.ndarray,
    rules: LineRules,
) -> np.ndarray:
    """Which lines fail a rule on punctuation, navigation, copies, shouting, symbols or boilerplate."""
    starts = np.searchsorted(found.starts, lines.starts)
    ends = np.searchsorted(found.starts, lines.ends)
    last = data[found.ends - 1] if len(found.ends) else data[:0]
    n = ends - starts
    shouted = _summed(last == ord("!"))
    linked = _summed(_links(data, found))
    chars = np.maximum(count_in(inside & LEADS[data], lines), 1)
    letters = np.maximum(count_in(_LETTER[data], lines), 1)
    unmarked = count_in(_SENTENCE[data], lines) == 0
    several = n >= rules.min_line_words
    return (
        unmarked & (n > rules.max_words_unmarked)
        | several & (_bars(data, lines) > rules.max_bar_share * n)
        | (linked[ends] - linked[starts] > rules.max_link_share * n)
        | _menus(with_words, unmarked & (n <= rules.max_menu_words), lines, rules.min_menu_lines)
        | (copies >= rules.min_short_copies) & (n <= rules.max_short_words)
        | several & (shouted[ends] - shouted[starts] > rules.max_shout_share * n)
        | several & (count_in(_UPPER[data], lines) > rules.max_upper_share * letters)
        | several & (count_in(_SYMBOL[data], lines) > rules.max_symbol_share * chars)
        | _boilerplate(data, lines)
    )


def _summed(mask: np.ndarray) -> np.ndarray:
    """How many of the first 0, 1, ... values are true."""
    return np.concatenate([[0], np.cumsum(mask)])


def _places(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where the bytes of ``mark`` begin."""
    at = np.flatnonzero(data[: max(len(data) - len(mark) + 1, 0)] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    return at


def _links(data: np.ndarray, found: Runs) -> np.ndarray:
    """Which words begin like a link, in letters of any case."""
    hit = np.zeros(len(found.starts), bool)
    for begin in LINKS:
        at = np.flatnonzero(found.ends - found.starts >= len(begin))
        for k, byte in enumerate(begin):
            at = at[LOWER[data[found.starts[at] + k]] == byte]
        hit[at] = True
    return hit


def _bars(data: np.ndarray, lines: Runs) -> np.ndarray:
    """Marks between entries in each line, without those that close a quotation."""
    total = np.zeros(len(lines.starts), np.int64)
    for marks, sign in ((BARS, 1), (OPENING, -1)):
        for mark in marks:
            at = _places(data, mark.encode())
            total += sign * (np.searchsorted(at, lines.ends) - np.searchsorted(at, lines.starts))
    return total


def _menus(with_words: np.ndarray, short: np.ndarray, lines: Runs, least: int) -> np.ndarray:
    """Which lines lie in a row of ``least`` short lines of one text; lines without words don't part it."""
    hit = np.zeros(len(lines.starts), bool)
    at = np.flatnonzero(with_words)
    if len(at):
        change = np.flatnonzero((np.diff(short[at]) != 0) | (np.diff(lines.text[at]) != 0)) + 1
        length = np.diff(np.concatenate([[0], change, [len(at)]]))
        hit[at] = short[at] & (np.repeat(length, length) >= least)
    return hit


def _boilerplate(data: np.ndarray, lines: Runs) -> np.ndarray:
    hit = np.zeros(len(lines.starts), bool)
    low = data.tobytes().lower()
    for phrase in BOILERPLATE:
        for m in re.finditer(re.escape(phrase), low):
            line = np.searchsorted(lines.starts, m.start(), side="right") - 1
            hit[line] |= bool(m.end() <= lines.ends[line])
    return hit


def _without(data: np.ndarray, bounds: np.ndarray, lines: Runs, failed: np.ndarray) -> pa.Array:
    """The texts without the failing lines and the line feed after each."""
    change = np.zeros(len(data) + 1, np.int8)
    change[lines.starts[failed]] += 1
    np.subtract.at(change, np.minimum(lines.ends[failed] + 1, len(data)), 1)
    # a line feed that ends a failing line goes with it, but none of the next text
    gone = np.cumsum(change[:-1]) > 0
    last = bounds[1:][bounds[1:] < len(data)]
    over = last[gone[last] & ~np.isin(last, lines.starts[failed])]
    gone[over] = False
    kept = np.concatenate([[0], np.cumsum(~gone, dtype=np.int64)])[bounds]
    return pa.Array.from_buffers(
        pa.large_string(),
        len(bounds) - 1,
        [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(data[~gone].tobytes())],
    ).cast(pa.string())
