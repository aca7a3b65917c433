"""Scaled sketches, spelling variants and source divergence against plain versions, and on odd inputs."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from platewise.llm import divergence, scaled_sketch, spelling

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n string, hash string, word string"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [
    (1, None, None, None, None, "x", "y", "z"),
    (2, "", "en", "s", 0, None, None, None),
    (2, "", "en", "s", 0, None, None, None),
    (None, "Some words without an id, colour and color.", "en", None, 5, None, None, None),
    (None, None, None, "s", 5, None, None, None),
    (5, "one two three four five six seven " * 4000, "en", "s", 1, None, None, None),
    (6, "\x00\t\n é 🙂 <|endoftext|>", None, "s", 1, None, None, None),
    (-7, "color color color colour Colour COLOUR colours", "en", "t", 1, None, None, None),
    (-7, "color color color colour Colour COLOUR colours", "en", "t", 1, None, None, None),
    (-7, "ÀÉÎõüß ÀÉÎõüß ÀÉÎõü ÀÉÎõü the", "fr", "t", 1, None, None, None),
]


def odd(spark, parts=3):
    return spark.createDataFrame(ODD, DOCS).repartition(parts)


def values(frame, *names):
    rows = frame.select(*names).collect() if names else frame.collect()
    return sorted((tuple(r) for r in rows), key=repr)


# --- scaled sketches -----------------------------------------------------------------


def plain_sketch(text, scale=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return []
    shingles = [" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))]
    hashes = {int(hashlib.md5(s.encode()).hexdigest()[:15], 16) for s in shingles}
    return sorted(h for h in hashes if h < 16**15 // scale) or [min(hashes)]


def plain_fingerprints(rows, scale=4):
    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    data = [(doc, text or "") for doc, text in rows]
    data.sort(key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1])), reverse=True)
    out = []
    for (doc, text), (_, following) in zip(data, data[1:] + data[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (plain_sketch(t, scale) for t in (text, edited, following))

        def near(x, y):
            return len({*x} & {*y}) / len({*x} | {*y}) if x or y else 1.0

        printed = ["".join(f"{h:015x}" for h in x) for x in (a, b)]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), *printed, near(a, b), near(a, c)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("parts", [1, 5])
def test_fingerprints_of_odd_rows(spark, parts):
    found = scaled_sketch.neighbour_fingerprints(odd(spark, parts))
    assert values(found, *COLUMNS) == plain_fingerprints([r[:2] for r in ODD])


@pytest.mark.parametrize("blocks", [1, 3, 1000])
def test_next_document_for_any_ids(spark, blocks):
    """Gaps, one crowded range, repeated ids and any number of ranges give the same neighbours."""
    rng = random.Random(3)
    ids = [rng.randrange(-50, 50) for _ in range(60)] + [10**15 + rng.randrange(400) for _ in range(120)] + [None, 7, 7, 7]
    rows = [(k, " ".join(rng.choice("abcdefg") * 2 for _ in range(rng.randrange(12)))) for k in ids]
    params = scaled_sketch.SketchParams(blocks_per_partition=blocks, most_blocks=blocks, scale=2)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = scaled_sketch.neighbour_fingerprints(frame, params)
    assert values(found, *COLUMNS) == plain_fingerprints(rows, 2)


def test_fingerprints_of_few_rows(spark):
    empty = odd(spark).limit(0)
    assert scaled_sketch.neighbour_fingerprints(empty).collect() == []
    assert scaled_sketch.sketches(empty).collect() == [] and scaled_sketch.merged(scaled_sketch.sketches(empty)).collect() == []
    alone = spark.createDataFrame([(3, "a b c d e f g h")], "doc_id bigint, text string")
    assert values(scaled_sketch.neighbour_fingerprints(alone), *COLUMNS) == plain_fingerprints([(3, "a b c d e f g h")])


def test_fingerprints_are_native(spark):
    plan = scaled_sketch.neighbour_fingerprints(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn|CartesianProduct|NestedLoop", plan.replace("Scan ExistingRDD", ""))


def test_merged_sketches_and_containment(spark):
    """The union of sketches is the sketch of all shingles; a small text is found whole in a large union."""
    rng = random.Random(5)
    texts = {k: " ".join(rng.choice("abcdef") for _ in range(n)) for k, n in enumerate([3, 7, 400, 6, 2, 0, 300])}
    groups = {0: "x", 1: "x", 2: "y", 3: "y", 4: "z", 5: "z", 6: None}
    frame = spark.createDataFrame([(k, t, groups[k]) for k, t in texts.items()], "doc_id bigint, text string, g string")
    own = frame.select("doc_id", "g", scaled_sketch.sketch(F.col("text")).alias("sketch"))
    union = defaultdict(set)
    for k, t in texts.items():
        union[groups[k]] |= {h for h in plain_sketch(t)}
    limit = 16**15 // 4
    expected = {(g, h) for g, hs in union.items() for h in ({h for h in hs if h < limit} or set(list(sorted(hs))[:1]))}
    merged = scaled_sketch.merged(own, "g")
    assert {tuple(r) for r in merged.collect()} == expected
    share = {r.doc_id: r.share for r in scaled_sketch.contained_in(own, merged.filter("g = 'y'")).collect()}
    known = {h for g, h in expected if g == "y"}
    for k, t in texts.items():
        mine = plain_sketch(t)
        assert share[k] == (sum(h in known for h in mine) / len(mine) if mine else 0.0)
    assert share[2] == 1.0


# --- spelling variants ---------------------------------------------------------------


def plain_variants(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    form, count = {}, Counter()
    for a in n:
        others = [b for b in n if near(a, b)]
        count[a] = len(others)
        best = min(others, key=lambda b: (-n[b], b), default=None)
        form[a] = best if best and n[best] >= 2 * n[a] else None
    out = []
    for a in n:
        root = a
        while form[root]:
            root = form[root]
        out.append((a, form[a], root, n[a], count[a], n[form[a]] if form[a] else None))
    return sorted(out, key=repr)


VARIANTS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_of_odd_rows(spark):
    for parts in (1, 4):
        found = spelling.spelling_variants(odd(spark, parts))
        assert values(found, *VARIANTS) == plain_variants([r[:2] for r in ODD])
    assert spelling.spelling_variants(odd(spark).limit(0)).collect() == []
    assert spelling.spelling_variants(odd(spark).filter("doc_id = 6")).collect() == []


def test_variants_of_words_close_together(spark):
    """Few letters, so nearly every word has many near ones, with repeats, ties and chains; few counts spill over tasks."""
    rng = random.Random(11)
    rows = []
    for doc in range(40):
        words = ["".join(rng.choice("abÀ") for _ in range(rng.choice([4, 5, 5, 6, 6, 7, 8]))) for _ in range(150)]
        rows.append((doc, " ".join(w * 1 for w in words for _ in range(rng.choice([1, 1, 2, 9])))))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = spelling.spelling_variants(frame, spelling.SpellingParams(gathered=50))
    assert values(found, *VARIANTS) == plain_variants(rows)


def test_one_edit_keeps_a_chunk(spark):
    """Every word one edit away, at every place, is found once, both ways."""
    base = "abcdefg"
    edits = {base[:k] + base[k + 1 :] for k in range(7)} | {base[:k] + c + base[k:] for k in range(8) for c in "axé"}
    edits |= {base[:k] + "é" + base[k + 1 :] for k in range(7)} | {"abcdefg" * 3, "gfedcba"}
    words = spark.createDataFrame([(w, 1) for w in {base, *edits}], "word string, n bigint")
    found = [(r.word, r.other) for r in spelling.near_words(words).collect()]
    assert len(found) == len(set(found))
    assert {b for a, b in found if a == base} == edits - {"abcdefg" * 3, "gfedcba"} == {a for a, b in found if b == base}


def test_long_chains_of_forms(spark):
    words = [("a" * k, f"{'a' * (k + 1)}") for k in range(5, 45)]
    forms = spark.createDataFrame(words, "word string, form string")
    found = {r.word: r.root for r in spelling.roots(forms, 1 << 41).collect()}
    assert found == {w: "a" * 45 for w, _ in words}
    assert spelling.roots(forms.limit(0), 0).collect() == []


def test_no_join_of_words_goes_through_the_driver(spark, monkeypatch):
    """Files of words are small beside the chunks made of them, so their size must not decide."""
    plans, write = [], spelling.saved

    def saved(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(spelling, "saved", saved)
    found = spelling.spelling_variants(odd(spark))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("Join") for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans)


# --- source divergence ---------------------------------------------------------------


def plain_audit(rows, least=3, top=200):
    docs, n, langs, groups = Counter(), Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [w.translate(LOW) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        for w in found:
            n[lang, source, w] += 1
            langs[lang, w] += 1
        for w in set(found):
            docs[lang, w] += 1
    kept = defaultdict(list)
    for (lang, w), times in docs.items():
        if times >= least:
            kept[lang].append(w)

    def share(counts, words):
        total = sum(counts[w] for w in words)
        return {w: 1 + 10**9 * (counts[w] + 1) // (total + len(words)) for w in words}

    p = {g: share({w: n[*g, w] for w in kept[g[0]]}, kept[g[0]]) for g in groups}
    q = {lang: share({w: langs[lang, w] for w in kept[lang]}, kept[lang]) for lang, _ in groups}
    out = []
    for lang, source in groups:
        own = p[lang, source]
        pairs = [
            (sum((own[w] - p[b][w]) ** 2 // p[b][w] for w in kept[lang]), b[1])
            for b in groups
            if b[0] == lang and b[1] != source
        ]
        words = [
            ((own[w] - q[lang][w]) ** 2 // q[lang][w], w)
            for w in kept[lang]
            if n[lang, source, w] and own[w] > q[lang][w]
        ]
        for part, found in (("pair", pairs), ("term", words)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            for rank, (value, item) in enumerate(found[: top if part == "term" else None], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out, key=repr)


def test_audit_of_odd_rows(spark):
    for parts in (1, 4):
        found = divergence.audit(odd(spark, parts))
        assert values(found) == plain_audit([(r[1], r[2], r[3]) for r in ODD])
    assert divergence.audit(odd(spark).limit(0)).collect() == []


@pytest.mark.parametrize("small", [False, True])
def test_audit_against_plain_sums(spark, small):
    """Shared, rare and missing terms; sources without kept terms; with little room at once, many small steps."""
    rng = random.Random(2)
    vocabulary = ["alpha", "Beta", "gamma", "ünder", "日本", "x", "ZZ", *(f"{a}{b}" for a, b in itertools.product("klm", "opq"))]
    rows = []
    for k in range(160):
        lang, source = rng.choice(["en", "de", None]), f"s{int(rng.random() ** 2 * 9)}"
        some = vocabulary[: rng.randrange(2, len(vocabulary))]
        rows.append((rng.choice([" ", "-", "9", "\n"]).join(rng.choices(some, k=rng.randrange(25))), lang, source))
    rows += [("once", "en", "lonely"), (None, "xx", "a"), ("", "xx", "b")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    params = divergence.DivergenceParams(gathered=20, pairs_at_once=16, top_terms=5) if small else divergence.DivergenceParams()
    expected = plain_audit(rows, top=params.top_terms)
    assert {r[0] for r in expected if r[2] == "pair" and r[4] == 0} >= {"xx"}
    assert values(divergence.audit(frame, params)) == expected


def test_shares_are_exact_for_large_counts(spark):
    rows = spark.createDataFrame([(10**18, 3 * 10**18 + 7, 11)], "n bigint, total bigint, kept bigint")
    params = divergence.DivergenceParams()
    found = rows.select(F.expr(divergence._share("n", "total", params)).alias("p")).first().p
    assert found == 1 + 10**9 * (10**18 + 1) // (3 * 10**18 + 7 + 11)
