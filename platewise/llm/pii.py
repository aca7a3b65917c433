"""Personal data by anchors: an Aho-Corasick automaton finds cues, local parsers find the bounds.

At-signs, digits, URL schemes and identifier words are the anchors; words and schemes are
found in any case. From an anchor a parser expands to the bounds of a match and validates
what lies between. As no match of the base kinds can do without its anchor, the result
equals a scan of the whole text. Work is proportional to the text's length.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import map_text

#: kinds of spans in the order of their listing; the first four are the base
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "login")

# Fixed patterns of two base kinds, which end at the first character that can't belong to them.
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: words after which an identifier may follow
CUES = (
    "account",
    "acct",
    "iban",
    "ssn",
    "passport",
    "customer id",
    "customer_id",
    "user id",
    "user_id",
    "token",
    "api key",
    "api_key",
    "apikey",
    "password",
    "secret",
)
#: schemes before which an authority stands
SCHEMES = ("http://", "https://", "ftp://", "ssh://")

_LOCAL_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBER_CHARS = "0123456789 .()+-"
_NUMBER_RUN = re.compile(r"[0-9\x20.()+-]+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_BEFORE_IDENTIFIER = re.compile(r"(?:[ \t_]?(?:number|no\.?|id|key))?[ \t]{0,2}[:=#]?[ \t]{0,2}[\"']?", re.IGNORECASE)
#: an identifier may have parts joined by dots, as signed tokens do, or numbers parted by single blanks
_IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*(?:[.+/=~][A-Za-z0-9_-]+)*")
_NUMBER_BLOCKS = re.compile(r"[0-9]+(?:[ -][0-9]+)+")
_BANK_BLOCKS = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{1,4}(?![A-Za-z0-9])| ?[A-Za-z0-9]{4}){2,8}")
_LOGIN = re.compile(r"[A-Za-z0-9._%+-]+:[^\s@/:]+@[A-Za-z0-9.-]+")
LEAST_IDENTIFIER = 6

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def bank_number(blocks: str) -> bool:
    """Whether country, check digits and the rest agree: 1 modulo 97, letters counting from 10."""
    chars = blocks.replace(" ", "").upper()
    return 15 <= len(chars) <= 34 and int("".join(str(int(c, 36)) for c in chars[4:] + chars[:4])) % 97 == 1


@cache
def automaton() -> ahocorasick.Automaton:
    """The anchors, each with its kind and length."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    for c in "0123456789":
        found.add_word(c, ("number", 1))
    for word in CUES:
        found.add_word(word, ("account", len(word)))
    for scheme in SCHEMES:
        found.add_word(scheme, ("login", len(scheme)))
    found.make_automaton()
    return found


_ASCII_LOW = {c: c + 32 for c in range(65, 91)}


def lowered(text: str) -> str:
    """The text in lower case, code point for code point."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_ASCII_LOW)


def _left(text: str, at: int, chars: str, least: int) -> int:
    """Where the run of ``chars`` that ends before ``at`` begins, not before ``least``."""
    size = 32
    while at > least:
        part = text[max(least, at - size) : at]
        rest = len(part.rstrip(chars))
        at -= len(part) - rest
        if rest:
            break
        size *= 2
    return at


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _email(text: str, sign: int, least: int) -> Span | None:
    """The address around an at-sign: the local part back to ``least`` at most, then a domain of two labels or more."""
    domain = _DOMAIN.match(text, sign + 1)
    if domain is None:
        return None
    start = _left(text, sign, _LOCAL_CHARS, least)
    return ("email", start, domain.end()) if start < sign else None


def _addresses(run: str, at: int) -> list[Span]:
    """Every four successive numbers of a dotted row, none above 255."""
    found = []
    for row in _DOTTED.finditer(run):
        parts = list(_PART.finditer(run, *row.span()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            values = [m[0].lstrip("0") for m in four]
            if all(len(v) <= 3 and int(v or "0") <= 255 for v in values):
                found.append(("ip", at + four[0].start(), at + four[3].end()))
    return found


def _numbers(run: str, at: int) -> list[Span]:
    found = _addresses(run, at)
    for m in CARD.finditer(run):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", at + m.start(), at + m.end()))
    for m in PHONE.finditer(run):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append(("phone", at + m.start(), at + m.end()))
    return found


def _account(text: str, after: int) -> Span | None:
    """The identifier that follows a cue: a valid bank number, blocks of digits, or a word with a digit, of any length."""
    at = _BEFORE_IDENTIFIER.match(text, after).end()
    blocks = _BANK_BLOCKS.match(text, at)
    if blocks:
        # what follows in the sentence may look like blocks: the longest valid number counts
        cuts = [blocks.end(), *[k for k in range(blocks.end() - 1, at, -1) if text[k] == " "]]
        end = next((k for k in cuts if bank_number(text[at:k])), None)
        if end:
            return ("account", at, end)
    found = [m for m in (_NUMBER_BLOCKS.match(text, at), _IDENTIFIER.match(text, at)) if m]
    best = max(found, key=lambda m: m.end(), default=None)
    if best is None or best.end() - at < LEAST_IDENTIFIER or not any("0" <= c <= "9" for c in best[0]):
        return None
    return ("account", at, best.end())


def spans(text: str) -> list[Span]:
    """All spans as (kind, start, end) in code points, ordered by kind as listed, then start."""
    found: list[Span] = []
    email_to = number_to = account_to = login_to = 0
    for last, (kind, size) in automaton().iter(lowered(text)):
        if kind == "number":
            if last >= number_to:
                start = _left(text, last, _NUMBER_CHARS, number_to)
                number_to = _NUMBER_RUN.match(text, last).end()
                found += _numbers(text[start:number_to], start)
        elif kind == "email":
            if last >= email_to and (one := _email(text, last, email_to)):
                found.append(one)
                email_to = one[2]
        elif kind == "account":
            before = last - size
            if last >= account_to and not (before >= 0 and text[before].isalnum()):
                if one := _account(text, last + 1):
                    found.append(one)
                    account_to = one[2]
        elif last >= login_to:
            m = _LOGIN.match(text, last + 1)
            if m:
                found.append(("login", *m.span()))
                login_to = m.end()
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def listed(found: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def masked(text: str, found: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    parts, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(parts) + text[at:] if found else text


def find_pii(documents: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans and all spans as text.

    A null or empty text has no spans: zero counts, the digest of the empty text, an empty
    list. Repeated rows and ids are looked at each by itself; other columns are not read.
    """

    def work(part: pa.RecordBatch) -> dict[str, object]:
        found = [spans(t) for t in part.column("text").to_pylist()]
        base = [[s for s in one if s[0] in BASE_KINDS] for one in found]
        out: dict[str, object] = {
            f"n_{kind}": [sum(s[0] == kind for s in one) for one in base] for kind in BASE_KINDS
        }
        return out | {
            "doc_id": part.column("doc_id"),
            "base_sha256": [hashlib.sha256(listed(one).encode()).hexdigest() for one in base],
            "spans": [listed(one) for one in found],
        }

    counts = ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS)
    return map_text(
        documents, ["doc_id"], work, f"doc_id bigint, {counts}, base_sha256 string, spans string"
    )


def mask_pii(documents: DataFrame) -> DataFrame:
    """The documents with personal data in ``text`` replaced; ``n_chars`` is counted anew, null texts stay null."""

    @F.pandas_udf("string")
    def hide(texts):
        return texts.map(lambda t: t if t is None else masked(t, spans(t)))

    out = documents.withColumn("text", hide("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in out.columns else out
