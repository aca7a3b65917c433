"""Text columns: cleaning, normalisation, key phrases, display tags."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TAG = r"<[^>]+>"
# Unicode white space plus the four separators U+001C..U+001F
URL = r"(?U)https?://[^\s\x1c-\x1f]+|www\.[^\s\x1c-\x1f]+"

# Classes list what they match: measured on eight cores, the negated form of the first one
# ran no faster than on one core. DROPPED is all but letters, digits and . , ! ? ' -
DROPPED = r"[\x00-\x20\x22-\x26\x28-\x2B\x2F\x3A-\x3E\x40\x5B-\x60\x7B-\x{10FFFF}]+"
BEYOND_ASCII = r"[\x{80}-\x{10FFFF}]"
# between the words of a normalised text
WORD_BREAK = r"[ .,!?'-]+"

# Contractions and their expansions, applied in this order.
CONTRACTIONS = [
    ("won't", "will not"),
    ("can't", "cannot"),
    ("n't", " not"),
    ("it's", "it is"),
    ("that's", "that is"),
    ("what's", "what is"),
    ("there's", "there is"),
    ("he's", "he is"),
    ("she's", "she is"),
    ("'re", " are"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
]

# Key words by subject.
KEY_WORDS = {
    "food": ["food", "pizza", "burger", "sushi", "pasta", "steak", "chicken", "fish", "salad", "soup", "dessert",
             "appetizer", "cocktail", "wine", "beer", "coffee", "tea"],
    "service": ["service", "staff", "waiter", "waitress", "server", "manager", "chef"],
    "atmosphere": ["atmosphere", "ambiance", "decor", "music", "view", "location", "parking"],
    "value": ["price", "value", "portion", "quality", "taste", "flavor", "fresh"],
}

# Tags that say nothing about a place, and the labels shown for known tags.
GENERIC_TAGS = [
    "point_of_interest",
    "establishment",
    "food",
    "store",
    "premise",
    "geocode",
    "subpremise",
]
TAG_LABELS = {
    "restaurant": "Restaurant",
    "bar": "Bar",
    "cafe": "Cafe",
    "bakery": "Bakery",
    "night_club": "Night Club",
    "meal_takeaway": "Takeaway",
    "meal_delivery": "Delivery",
    "lodging": "Hotel",
    "museum": "Museum",
    "spa": "Spa",
    "tourist_attraction": "Tourist Attraction",
    "bowling_alley": "Bowling",
    "grocery_or_supermarket": "Grocery",
}

# where a word starts or ends
WORD_EDGE = r"(?<=\w)(?=\W)|(?<=\W)(?=\w)"


def strip_markup(text: Column, mode: str = "pipeline") -> Column:
    """Remove tags and collapse white space.

    ``pipeline`` drops a tag and trims before collapsing; ``job`` puts a blank for the
    tag and trims last. The two differ on ``a<b>b</b>c`` and on outer tabs.
    """
    if mode == "pipeline":
        return F.regexp_replace(F.trim(F.regexp_replace(text, TAG, "")), r"\s+", " ")
    if mode == "job":
        return F.trim(F.regexp_replace(F.regexp_replace(text, TAG, " "), r"\s+", " "))
    raise ValueError(f"unknown cleaning mode {mode!r}")


def word_count(text: Column) -> Column:
    return F.size(F.split(text, r"\s+"))


def nfkd(text: Column) -> Column:
    """Unicode compatibility decomposition.

    Spark has no such function. Only rows with a character beyond ASCII are sent to
    Python; for all others the batch holds a null.
    """

    # a nested function travels by value, so executors need no copy of this package
    @F.arrow_udf(StringType())
    def decompose(texts: pa.Array) -> pa.Array:
        # a few texts at a time are Python objects, whatever the size of the batch
        parts = []
        for start in range(0, len(texts), 64):
            some = texts.slice(start, 64)
            if some.null_count == len(some):
                parts.append(pa.nulls(len(some), pa.string()))
            else:
                plain = [None if t is None else unicodedata.normalize("NFKD", t) for t in some.to_pylist()]
                parts.append(pa.array(plain, pa.string()))
        return pa.concat_arrays(parts) if parts else pa.nulls(0, pa.string())

    beyond_ascii = F.when(text.rlike(BEYOND_ASCII), text)
    return F.coalesce(decompose(beyond_ascii), text)


def where_found(text: Column, marks: Sequence[str], change: Callable[[Column], Column]) -> Column:
    """``change`` of the texts that hold one of the marks; the others are passed on unread by it.

    The one-element transform evaluates ``text`` once although the branches name it
    several times.
    """

    def changed(t: Column) -> Column:
        found = reduce(lambda a, b: a | b, [F.contains(t, F.lit(m)) for m in marks])
        return F.when(found, change(t)).otherwise(t)

    return F.transform(F.array(text), changed)[0]


def expand_contractions(text: Column) -> Column:
    """Replace contractions in their fixed order; texts without an apostrophe skip it."""

    def expand(t: Column) -> Column:
        for short, full in CONTRACTIONS:
            t = F.replace(t, F.lit(short), F.lit(full))
        return t

    return where_found(text, ["'"], expand)


def truncate_words(text: Column, max_words: int = 512) -> Column:
    """The first words of a text whose words are parted by single blanks."""
    return F.substring_index(text, " ", max_words)


def normalize_text(text: Column) -> Column:
    """Model input: decomposed, without markup and links, expanded, basic characters only.

    Null and empty give ``''``. White space is among the characters outside the kept
    set, so one replacement both drops characters and collapses blanks. The whole text is
    kept; a model that reads only so many words cuts its input itself.
    """
    out = nfkd(F.coalesce(text, F.lit("")))
    # what each pattern can't do without is looked for first: most texts have none of it
    out = where_found(out, ["<"], lambda t: F.regexp_replace(t, TAG, " "))
    out = where_found(out, ["http", "www."], lambda t: F.regexp_replace(t, URL, " "))
    out = expand_contractions(out)
    return F.trim(F.regexp_replace(out, DROPPED, " "))


def key_phrases(normalized: Column) -> Column:
    """Distinct key words of an already normalised text, sorted.

    A key word counts where it stands as a whole word, so the words of the text are
    intersected with the list instead of searching the text for each of them.
    """
    words = [F.lit(w) for group in KEY_WORDS.values() for w in group]
    return F.array_sort(F.array_intersect(F.split(F.lower(normalized), WORD_BREAK), F.array(*words)))


def capital_words(text: Column) -> Column:
    """Every word starts with a capital; the rest of it stays as it is. Hyphens part words."""
    parts = F.split(text, WORD_EDGE)
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substring(p, 2, 1 << 30))), "")


def display_types(types: Column) -> Column:
    """Up to three labels for a place's tags; ``Restaurant`` when nothing specific is left."""
    labels = F.create_map(*[F.lit(x) for pair in TAG_LABELS.items() for x in pair])
    specific = F.filter(F.coalesce(types, F.array().cast("array<string>")), lambda t: ~t.isin(GENERIC_TAGS))
    shown = F.transform(
        F.slice(specific, 1, 3),
        lambda t: F.coalesce(F.try_element_at(labels, t), capital_words(F.replace(t, F.lit("_"), F.lit(" ")))),
    )
    return F.when(F.size(specific) == 0, F.array(F.lit("Restaurant"))).otherwise(shown)
