"""The operators for training data against plain versions, planted cases and odd inputs."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from platewise.llm import bpe, language, line_rules, maxscore, ngram_join, packing, pii, quality, toxicity, warc
from platewise.llm.common import raw_text, table
from platewise.llm.graph import components

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string"
ODD = [
    (1, None, None, None, None, "x", "y"),
    (2, "", "en", "s", 0, None, None),
    (2, "", "en", "s", 0, None, None),
    (None, "Some words without an id.", "en", None, 5, None, None),
    (5, "one two three four five six seven " * 4000, "en", "s", 1, None, None),
    (6, "\x00\t\n é 🙂 <|endoftext|>", None, "s", 1, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def vocab():
    return bpe.load(public_tokenizers.path("byte_bpe_50k.json"))


def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def run(spark, name):
    return entry_point.queries()[name](spark, SF_DIR)


def test_search_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    expected = con.execute(entry_point.oracle_sql()["op2_maxscore"]).fetchall()
    assert sorted(tuple(r) for r in run(spark, "op2_maxscore").collect()) == sorted(expected)


def test_search_skips_bad_vectors_and_breaks_ties(spark):
    data = [
        (0, [1.0, 0.0]),
        (0, [1.0, 0.0]),
        (1, [0.5, None]),
        (2, [float("nan"), 1.0]),
        (3, None),
        (None, [1.0, 1.0]),
        (9, [1.0, 5.0]),
        (7, [1.0, -5.0]),
        (8, [1.0]),
        (4, [-1.0, 2.0]),
    ]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    found = [tuple(r) for r in maxscore.top_k(frame).orderBy("rank").collect()]
    assert found == [(0, 1, 7, 65536), (0, 2, 8, 65536), (0, 3, 9, 65536), (0, 4, 4, -65536)]
    assert maxscore.top_k(frame.filter("vec_id = 5")).collect() == []


@pytest.mark.parametrize("density", [0.1, 1.0])
def test_search_kernel(density):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-9, 10, (500, 12)) * (rng.random((500, 12)) < density)
    params = maxscore.SearchParams(first=32, stride=64)
    for largest in (9, 1 << 60):
        shard = maxscore.Shard(np.arange(500), vectors, largest)
        for own in range(40):
            scores = vectors @ vectors[own]
            order = [k for k in np.lexsort((np.arange(500), -scores)) if k != own][:5]
            ids, found = maxscore.search(shard, vectors[own], own, params)
            positive = scores[order] > 0
            # what shares no term with a query has score 0 and may be passed over only below the k-th
            assert found.tolist() == scores[order].tolist()
            assert ids[positive].tolist() == np.array(order)[positive].tolist()


def brute_links(data):
    sets, parent = {}, {}
    for doc, text in data:
        w = WORD.findall((text or "").translate(LOW))
        sets[doc] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
        parent[doc] = doc

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for doc in sorted(sets):
        shared = Counter(other for token in sets[doc] for other in holders[token])
        for other, both in shared.items():
            if 100 * both >= 75 * (len(sets[doc]) + len(sets[other]) - both):
                low, high = sorted((root(doc), root(other)))
                parent[high] = low
        for token in sets[doc]:
            holders[token].append(doc)
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


def test_join_equals_brute_force(spark, docs, rows):
    found = ngram_join.link(docs).collect()
    expected = brute_links(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert len(found) == len(rows)


def test_join_of_chains_and_frequent_tokens(spark):
    """Chains of edits, many copies, small sets; limits so low that tokens are frequent and groups are split."""
    random.seed(4)
    words = [f"w{k}" for k in range(60)]
    data, base = [], [random.choice(words) for _ in range(90)]
    for k in range(160):
        base = list(base)
        base[random.randrange(90)] = random.choice(words)
        data.append((k, " ".join(base[: random.choice([90, 90, 80])])))
    data += [(1000 + k, " ".join(random.choice("ab") for _ in range(k % 9))) for k in range(80)]
    data += [(2000 + k, f"The same  text\tin many copies {k % 2} of it") for k in range(40)] + [(3000, None)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    params = ngram_join.JoinParams(frequent=3, task_tokens=700, slot_bits=22, block_bits=18)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(frame, params).collect()}
    assert found == brute_links(data)


def test_large_groups_are_linked_to_their_head_first(spark):
    """Hot groups of near copies, some of which are near each other but not the head; tasks of a few sets each."""
    random.seed(5)
    words = [f"w{k}" for k in range(400)]
    data, number = [], 0
    for size in (150, 40):
        base = [random.choice(words) for _ in range(100)]
        for k in range(size):
            own = list(base)
            for _ in range(random.choice([0, 1, 2, 3, 5])):
                own[random.randrange(100)] = random.choice(words)
            data.append((number := number + 1, " ".join(own)))
    data += [(1000 + k, data[k % 150][1]) for k in range(60)] + [data[3], data[4]]
    frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    expected = brute_links(data)
    for task_tokens in (300, 1 << 20):
        params = ngram_join.JoinParams(task_tokens=task_tokens, slot_bits=20)
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(frame, params).collect()}
        assert found == expected


def test_near_ones_do_not_meet_each_other(spark):
    """Every two of a group share a task, but for two that are near its head; without others there is no task."""
    members = spark.createDataFrame([(h, h + k, 10) for h in (100, 200, 300) for k in range(30)], "head bigint, node bigint, n bigint")
    near = spark.createDataFrame([(100, 100 + k) for k in range(25)] + [(200, 200 + k) for k in range(30)], "head bigint, node bigint")
    tasks = defaultdict(set)
    for r in ngram_join._dealt(members, near, 50).collect():
        tasks[r.head, r.i, r.j].add(r.node)
    met = {(a, b) for nodes in tasks.values() for a in nodes for b in nodes}
    for head, others in ((100, range(25, 30)), (300, range(30))):
        assert {(head + a, head + b) for a in others for b in range(30)} <= met
    assert not any(h == 200 for h, _, _ in tasks)
    # 25 near ones of 10 tokens make 5 blocks, 5 others one: 6 tasks, where 6 blocks would make 21
    assert sum(h == 100 for h, _, _ in tasks) <= 6


def test_blocks_of_counts_follow_the_session(spark, docs):
    """As many tasks sum the counts as the session has shuffle partitions; results don't depend on it."""
    given = ngram_join.JoinParams()
    for partitions, bits in ((1, 20), (128, 20), (129, 19), (1000, 17), (1 << 30, ngram_join.LEAST_BLOCK_BITS)):
        assert ngram_join.with_blocks(given, partitions).block_bits == bits
    expected = {tuple(r) for r in ngram_join.link(docs).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "300")
        small = ngram_join.JoinParams(slot_bits=18)
        assert {tuple(r) for r in ngram_join.link(docs, small).collect()} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_candidates_of_a_large_group_need_no_window(spark):
    random.seed(6)
    data = [([1, 2, k], k % 9) for k in range(10, 400)] + [([random.randrange(1000, 1200)], 100 + k) for k in range(300)] + [([5000], 7), ([], 8)]
    sets = spark.createDataFrame(data, "signatures array<bigint>, node bigint").repartition(6)
    found = ngram_join._candidates(sets)
    holders = defaultdict(set)
    for own, node in data:
        for signature in own:
            holders[signature].add(node)
    expected = {(min(nodes), node) for nodes in holders.values() if len(nodes) > 1 for node in nodes}
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    # a window would bring all rows of a signature to one task
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 90), (90, 95), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {k: 0 for k in range(51)} | {90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_archives_round_trip(spark):
    big = "<p>é</p>" * 50_000
    data = [(3, "http://a/ b", big), (1, None, big), (2, "u", None), (4, "u", ""), (4, "u", "x"), (None, "u", big), (5, "u", "y")]
    pages = spark.createDataFrame(data, "page_id bigint, url string, html string")
    params = warc.ArchiveParams(chunk_bytes=1000, segment_bytes=100_000)
    chunks = warc.read_archives(warc.write_archives(pages, params), params).collect()
    texts = defaultdict(dict)
    for c in chunks:
        texts[(c.page_id, c.record_type, c.record_id)][c.chunk_no] = bytes(c.chunk or b"")
    whole = sorted((k[0] is None, k[0], k[1], b"".join(v[n] for n in sorted(v)).decode()) for k, v in texts.items() if k[0])
    assert [(w[1], w[2], w[3]) for w in whole] == [
        (1, "response", big),
        (2, "response", ""),
        (3, "revisit", ""),
        (4, "response", "x"),
        (4, "revisit", ""),
        (5, "response", "y"),
    ]
    last = {(c.page_id, c.record_type): c for c in chunks if c.last}
    assert last[3, "revisit"].refers_to == 1 and last[4, "revisit"].refers_to == 2
    assert last[3, "revisit"].bytes_so_far == len(big.encode()) == last[None, "response"].bytes_so_far
    assert last[1, "response"].digest_so_far == base64.b32encode(hashlib.sha1(big.encode()).digest()).decode()
    assert warc.read_archives(warc.write_archives(pages.limit(0))).collect() == []


def test_archive_query(spark):
    pages = [tuple(r) for r in table(spark, SF_DIR, "pages").select("page_id", "html").collect()]
    first = {}
    for page, html in sorted(pages):
        first.setdefault(html or "", page)
    expected = []
    for page, html in pages:
        raw, again = (html or "").encode(), first[html or ""] != page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expected.append((page, len(raw), digest, "revisit" if again else "response", first[html or ""] if again else None))
    assert sorted(tuple(r) for r in run(spark, "op5_warc_chunks").collect()) == sorted(expected)


def test_bpe_equals_library(spark, rows, vocab):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(3)
    marks = [*"aab  \n\t'sdtmrevl'12.!?éß中🙂<|>", "<|endoftext|>", "'re", "'ll", " ", "\r\n", "\x1c", "\x85", "aaaaaaa", "ſ", "²"]
    texts = ["".join(random.choice(marks) for _ in range(random.randint(0, 60))) for _ in range(2000)]
    texts += ["", "a" * 3000, " " * 300, "ab" * 2000 + "c", "<|endoftext|>"]
    ids, bounds = bpe.encode(*raw_text(pa.array(texts, pa.large_string())), vocab)
    content, ends = bpe.decode(ids, bounds, vocab)
    for k, encoded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == encoded.ids, texts[k]
        assert content[ends[k] : ends[k + 1]].tobytes().decode() == texts[k]
    found = {r.doc_id: r for r in run(spark, "op7_bpe_ranks").collect()}
    for (doc, text), encoded in zip(rows, library.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        raw = np.array(encoded.ids, "<u4").tobytes()
        assert found[doc].ids_sha256 == hashlib.sha256(raw).hexdigest() and found[doc].n_tokens == len(encoded.ids)
        assert found[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_long_words_take_time_in_proportion(vocab):
    """Words of hundreds of kilobytes, as unspaced text or encoded files have them, against the library."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(11)
    marks = ["ab", "abcdefghij", "aeioustrnl", "é漢ö", "ABCxyz"]
    words = ["".join(random.choice(random.choice(marks)) for _ in range(random.randint(20, 300))) for _ in range(300)]
    words += ["".join(random.choices(marks[-1] + marks[1], k=400_000)), "a" * 300_001, "é" * 100_000]
    begin = time.monotonic()
    ids, bounds = bpe.encode(*raw_text(pa.array(words, pa.large_string())), vocab)
    assert time.monotonic() - begin < 20
    for k, encoded in enumerate(library.encode_batch(words, add_special_tokens=False)):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == encoded.ids, words[k][:300]


def test_packing_is_gapless_and_whole(spark, rows):
    found = run(spark, "op9_packing_differencing").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: e.ids + [0] for (d, _), e in zip(rows, library.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True)}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for doc, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids[doc])) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[doc][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[doc])
    padding = total = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        total += at
        padding += (1024 - at) * (at & (at - 1) > 0)
    assert padding < 0.01 * total


def test_pieces_wait_for_the_next_batch(spark, vocab):
    """Small batches of one partition fill windows together: only the end of the partition is left half empty."""
    data = [(k, "word " * (250 + 13 * k)) for k in range(60)] + [(None, "no id"), (3, None), (3, "")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string").coalesce(1)
    for params in (packing.PackingParams(batch_bytes=1), packing.PackingParams(batch_bytes=3000, group=90), packing.PackingParams()):
        found = packing.pack(frame, vocab, params, with_ids=True).collect()
        filled = Counter()
        for r in found:
            filled[r.sequence_id] += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        assert max(filled.values()) <= 1024
        assert len(filled) <= sum(filled.values()) / 1024 / 0.97 + 2
        ends = [r for r in found if r.start + r.length == r.doc_tokens]
        assert Counter(r.doc_id for r in ends) == Counter(d for d, _ in data)
        assert sorted(packing_rows(found)) == sorted(packing_rows(packing.pack(frame, vocab, params, with_ids=True).collect()))


def packing_rows(found):
    return [(r.sequence_id, r.offset, r.doc_id or -1, r.start, r.length) for r in found]


def test_differencing():
    random.seed(1)
    for windows in (1, 2, 7, 40):
        sizes = [random.randint(1, 128) for _ in range(200)]
        found = packing.difference(sizes, windows)
        assert sorted(k for items in found for k in items) == list(range(200))
        sums = [sum(sizes[k] for k in items) for items in found]
        assert len(sums) == windows and max(sums) - min(sums) <= 128
    assert packing.near_equal_windows([], 1024) == []


def brute_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", pii.CARD, 13, 19), ("phone", pii.PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = [c for c in m[0] if c.isdigit()]
            if low <= len(digits) <= high and (kind == "phone" or pii.luhn("".join(digits))):
                out.append((kind, *m.span()))
    return out


def test_pii_equals_scan(spark, rows):
    random.seed(1)
    texts = ["".join(random.choice("0123456789 .()+-@a.com12%_\n") for _ in range(random.randint(0, 80))) for _ in range(5000)]
    for text in [*texts, "4111 1111 1111 1111", "+1 (213) 555-5069 a@b.c 1.2.3.256", "9" * 6000, " " * 9000 + "1"]:
        assert [s for s in pii.spans(text) if s[0] in pii.BASE_KINDS] == brute_spans(text)
    found = {r.doc_id: r for r in run(spark, "op8_pii_anchors").collect()}
    for doc, text in rows:
        expected = brute_spans(text)
        assert found[doc].base_sha256 == hashlib.sha256(pii.listed(expected).encode()).hexdigest()
        assert (found[doc].n_email, found[doc].n_ip) == tuple(sum(s[0] == k for s in expected) for k in ("email", "ip"))
    assert pii.spans('token = "24be64439e3e49cf"') == [("account", 9, 25)]
    assert pii.masked("write a@b.co now", pii.spans("write a@b.co now")) == "write <EMAIL> now"


def test_line_rules_equal_plain_counts(spark, rows):
    found = {r.doc_id: r for r in run(spark, "op10_line_rules").collect()}
    for doc, text in rows:
        words, lines, seen, repeats = WORD.findall(text), text.split("\n"), set(), 0
        for line in lines:
            if WORD.search(line):
                repeats += line in seen
                seen.add(line)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times, marked = Counter(windows), set()
        for i, w in enumerate(windows):
            if times[w] > 1:
                marked |= {i, i + 1, i + 2}
        failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
        r = found[doc]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", text)), repeats)
        assert (r.n_repeat_words, r.base_failed) == (len(marked), failed)
        assert not (failed and r.kept)


def plain_verdict(text, rules=line_rules.LineRules()):
    """Removed lines, removed characters and the verdict, line by line."""
    lines = text.split("\n")
    holds = [k for k, line in enumerate(lines) if WORD.search(line)]
    times, seen, failed = Counter(lines[k] for k in holds), set(), set()
    unmarked = {k for k in holds if not re.search(r"[.!?;:]", lines[k])}
    menu = []
    for k in [*holds, None]:
        if k in unmarked and len(WORD.findall(lines[k])) <= rules.max_menu_words:
            menu.append(k)
            continue
        if len(menu) >= rules.min_menu_lines:
            failed |= set(menu)
        menu = []
    for k in holds:
        line = lines[k]
        low = line.translate(LOW)
        words = WORD.findall(line)
        n, chars = len(words), sum(map(len, words))
        bars = sum(line.count(c) for c in line_rules.BARS) - sum(line.count(c) for c in line_rules.OPENING)
        letters, upper = len(re.findall("[A-Za-z]", line)), len(re.findall("[A-Z]", line))
        links = sum(w.translate(LOW).startswith(("http://", "https://", "www.")) for w in words)
        tests = [
            line in seen,
            k in unmarked and n > rules.max_words_unmarked,
            n >= rules.min_line_words and bars > rules.max_bar_share * n,
            links > rules.max_link_share * n,
            times[line] >= rules.min_short_copies and n <= rules.max_short_words,
            n >= rules.min_line_words and sum(w[-1] == "!" for w in words) > rules.max_shout_share * n,
            n >= rules.min_line_words and upper > rules.max_upper_share * max(letters, 1),
            n >= rules.min_line_words and len(re.findall(r"[#*$%&|<>]", line)) > rules.max_symbol_share * max(chars, 1),
            any(p.decode() in low for p in line_rules.BOILERPLATE),
        ]
        if any(tests):
            failed.add(k)
        seen.add(line)
    total = sum(map(len, WORD.findall(text)))
    removed = sum(len(w) for k in failed for w in WORD.findall(lines[k]))
    return len(holds), len(failed), removed, removed <= rules.max_lost_share * total


LINES = [
    "A plain line of a text that ends as it should.",
    "This one goes on and on and never has any mark to part what it says at all",
    "Home | About | Contact",
    "Home » Shop › Boots",
    "Il a dit « oui » puis « non » hier.",
    "https://a.example/x www.b.example",
    "See HTTPS://a.example for more of it.",
    "Home",
    "About us",
    "Our big shop",
    "Read more",
    "Share this now",
    "",
    " \t ",
    "STOP! NOW! HERE!",
    "THE WHOLE LINE IS LOUD.",
    "# * $ a b",
    "Tous droits réservés.",
    "Alle Rechte vorbehalten, 2020.",
    "é ü 🙂 · • → .",
]


def test_verdict_equals_plain_rules(spark, rows):
    random.seed(10)
    texts = ["\n".join(random.choices(LINES, k=random.randint(0, 14))) for _ in range(1500)]
    data = [(10**6 + k, t) for k, t in enumerate(texts)] + [(d, t) for d, t in rows]
    frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in line_rules.clean_lines(frame).collect()}
    assert len(found) == len(data)
    for doc, text in data:
        r = found[doc]
        n, failed, removed, kept = plain_verdict(text)
        assert (r.n_lines, r.n_removed_lines, r.removed_chars) == (n, failed, removed), text
        assert r.kept == (kept and not r.base_failed)


def test_clean_documents_keep_their_lines(spark, docs):
    """Documents of good quality lose hardly any of their text."""
    labels = table(spark, SF_DIR, "labels").filter("quality = 1").select("doc_id")
    found = line_rules.clean_lines(docs, with_text=False).join(labels, "doc_id", "left_semi").filter("not base_failed").collect()
    assert sum(r.kept for r in found) >= 0.97 * len(found)


def test_clean_text_loses_whole_lines(spark):
    text = "A first line that stays here.\nhome | about | contact | more\nA first line that stays here.\nLast one stays.\n"
    frame = spark.createDataFrame([(1, text), (2, "HOME | A | B"), (3, "ok."), (4, None)], "doc_id bigint, text string")
    found = {r.doc_id: r.clean_text for r in line_rules.clean_lines(frame).collect()}
    assert found == {1: "A first line that stays here.\nLast one stays.\n", 2: "", 3: "ok.", 4: ""}


@pytest.mark.parametrize(
    "name, column, least",
    [("op1_quality_rules", "quality", 0.95), ("op3_toxicity_gru", "toxic", 0.8)],
)
def test_classifiers_on_held_out_rows(spark, name, column, least):
    labels = {r.doc_id: r[column] for r in table(spark, SF_DIR, "labels").collect()}
    found = run(spark, name).collect()
    assert len(found) == table(spark, SF_DIR, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= least * len(held)


def test_language_on_held_out_rows(spark, docs):
    known = {r.doc_id: r.lang for r in docs.collect()}
    found = run(spark, "op6_language_bayes").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.98 * len(held)


def test_gradients():
    params = toxicity.ToxicityParams(word_bits=4, char_bits=4, window=5, stride=3, dim=3, hidden=2, attention=3)
    w = {k: v.astype(float) for k, v in toxicity.initial(params).items()}
    rng = np.random.default_rng(0)
    x, at, y = rng.standard_normal((7, 3)), rng.integers(0, 6, (4, 5)), np.array([1.0, 0, 1, 0])
    x[-1], at[0, 3:], at[2, 1:] = 0, -1, -1
    _, g, _ = toxicity.gradients(x, at, w, y)
    for name, grad in g.items():
        first = (0,) * w[name].ndim
        kept, losses = w[name][first], []
        for step in (1e-3, -1e-3):
            w[name][first] = kept + step
            losses.append(toxicity.gradients(x, at, w, y)[0])
        w[name][first] = kept
        assert abs(grad[first] - (losses[0] - losses[1]) / 2e-3) < 1e-5, name


def test_odd_rows(spark, docs, vocab):
    """Nulls, empty and long texts, repeated rows and clashing columns give a defined row each."""
    frame, labels = odd(spark), table(spark, SF_DIR, "labels")
    model = language.train(docs)
    found = language.identify(frame, model).collect()
    assert Counter(r.lang_pred for r in found)["und"] == 3 and len(found) == 6
    assert {r.lang_pred for r in language.identify(frame, language.train(frame.limit(0))).collect()} == {"und"}
    assert len(quality.score(frame, quality.train(docs, labels)).collect()) == 6
    assert {r.score for r in quality.score(frame, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    assert {r.score for r in toxicity.score(frame, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}
    assert [r.n_email for r in pii.find_pii(frame).collect()] == [0] * 6
    assert {r.doc_id: r.length for r in packing.pack(frame, vocab).filter("doc_id < 3").collect()} == {1: 1, 2: 1}
    assert sum(r.kept for r in line_rules.clean_lines(frame).collect()) == 0
    linked = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link(frame).collect()}
    assert linked == {(1, 0, 1), (2, 0, 2), (5, 7, 5), (6, 1, 6)}
    empty = frame.limit(0)
    for out in (pii.find_pii(empty), packing.pack(empty, vocab), line_rules.clean_lines(empty), ngram_join.link(empty)):
        assert out.collect() == []


def test_pipeline_keeps_what_stages_decide(spark):
    import corpus_pipeline

    found = corpus_pipeline.run(spark, SF_DIR)
    kept = {r.doc_id for r in found.select("doc_id").distinct().collect()}
    labels = {r.doc_id: r for r in table(spark, SF_DIR, "labels").collect()}
    bad = [d for d in kept if d in labels and labels[d].quality == 0]
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert len(bad) < 0.05 * len(kept) and len(kept & set(clean)) > 0.85 * len(clean)
    linked = {r.doc_id: r.component_id for r in ngram_join.link(table(spark, SF_DIR, "documents")).collect()}
    assert len({linked[d] for d in kept}) > 0.97 * len(kept)


def test_stages_decide_row_by_row(spark, docs, monkeypatch):
    """Rows that share an id, and rows without one, stay or go by their own texts."""
    import corpus_pipeline

    labels = table(spark, SF_DIR, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for module, stage, good in ((toxicity, corpus_pipeline.drop_toxic, 0), (quality, corpus_pipeline.keep_quality, 1)):
        model = module.train(docs, labels)
        monkeypatch.setattr(module, "train", lambda *_, m=model: m)
        scored = sorted((r.predicted == good, r.doc_id) for r in module.score(docs, model).collect())
        goes, stays = texts[scored[0][1]], texts[scored[-1][1]]
        assert not scored[0][0] and scored[-1][0]
        frame = [(k, t, "en", None, 1, None, None) for k in (1, None) for t in (goes, stays, goes)]
        found = stage(spark, spark.createDataFrame(frame, DOCS), SF_DIR)
        assert found.columns == docs_columns(DOCS)
        assert sorted((r.doc_id or 0, r.text) for r in found.collect()) == [(0, stays), (1, stays)]


def docs_columns(schema):
    return [x.split(" ")[0] for x in schema.split(", ")]


def test_one_row_of_each_equal_set_stays(spark):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near = a + " more"
    data = [(5, a), (5, a), (5, b), (None, near), (3, near), (None, c), (None, c), (7, ""), (7, ""), (8, None), (None, ""), (None, None)]
    for parts in (1, 4):
        frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(parts)
        found = corpus_pipeline.drop_near_duplicates(spark, frame, SF_DIR).collect()
        expected = [(3, near), (5, b), (None, c), (7, ""), (8, None), (None, ""), (None, None)]
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_what_reaches_the_driver_is_bounded():
    """Sums of a fixed size, classes of a label, and samples bounded by a parameter; nothing else is collected."""
    from pathlib import Path

    found = {}
    for path in Path(bpe.__file__).parent.glob("*.py"):
        n = len(re.findall(r"\.(?:collect|toPandas|toArrow|toLocalIterator)\(", path.read_text()))
        if n:
            found[path.name] = n
        assert not re.search(r"\.(localCheckpoint|crossJoin)\(", path.read_text())
    assert found == {"language.py": 1, "ngram_join.py": 2, "quality.py": 2, "toxicity.py": 1}


# --- added spans, long runs ----------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("api_key=" + "a1" * 40, "a1" * 40),
        ("token: eyJhbGci.eyJzdWIi.abc-123_x", "eyJhbGci.eyJzdWIi.abc-123_x"),
        ("IBAN DE89 3704 0044 0532 0130 00 from me", "DE89 3704 0044 0532 0130 00"),
        ("my iban: GB82WEST12345698765432.", "GB82WEST12345698765432"),
        ("Customer ID: AB12CD34EF", "AB12CD34EF"),
        ("Api_Key: abc12345", "abc12345"),
        ("İ SSN 123 45 6789, so", "123 45 6789"),
        ("account number 12", None),
        ("the secret garden", None),
        ("mytoken abc12345", None),
    ],
)
def test_identifiers_after_cues(text, found):
    assert [text[a:b] for kind, a, b in pii.spans(text) if kind == "account"] == ([found] if found else [])


def test_spans_of_long_runs_take_linear_time():
    import time

    runs = ["a" * 1_000_000 + "@ ", "1" * 1_000_000, "a@" * 300_000, "1." * 500_000, "+1(" * 300_000, "token " * 200_000]
    start = time.perf_counter()
    found = [pii.spans(t) for t in [*runs, "a" * 500_000 + "@b.co"]]
    assert time.perf_counter() - start < 20
    assert [len(f) for f in found] == [0, 0, 0, 125_000, 0, 0, 1] and found[-1] == [("email", 0, 500_005)]


def test_quality_statistics_are_computed_once(spark, docs):
    """However many rules there are, and with a filter on the score, each pattern stands once in the plan."""
    rule = lambda k: (((k % 10, k % 3 == 0, k / 7.0), ((k + 3) % 10, k % 2 == 0, k / 3.0)), 0.1 * (-1) ** k)
    model = quality.QualityModel(3.0, tuple(rule(k) for k in range(60)), quality.QualityParams())
    one = docs.filter(quality.score_column(model) >= 0.7)
    two = quality.score(docs, model).filter("predicted = 1")
    for frame in (one, two):
        execution = frame._jdf.queryExecution()
        text = execution.optimizedPlan().toString()
        conditions = [line for line in text.splitlines() if "Filter" in line]
        assert len(conditions) == 1 and conditions[0].count("regexp_replace") == 4 and conditions[0].count("split(") == 1
    known = {r.doc_id for r in two.select("doc_id").collect()}
    assert {r.doc_id for r in one.select("doc_id").collect()} == known and known


def test_quality_score_equals_plain_rules(spark):
    """Every rule by hand: a product of conditions over the ten statistics, weighed and squashed."""
    import math

    frame = odd(spark)
    texts = [r[1] or "" for r in ODD]

    def plain(text):
        words = re.split(r"[\x20\x09-\x0D]+", text)
        chars, n = max(len(text), 1), len(words)
        count = lambda chars_in: sum(c in chars_in for c in text)
        upper = sum(c.isupper() for c in text)
        digits, marks = count("0123456789"), count(".,;:?")
        return [
            math.log1p(len(text)), len(text) / n, len(set(words)) / n, count("#*$%&|<>") / chars, upper / chars,
            digits / chars, marks / n, count("!") / n, count("|") / n, count("\n") / n,
        ]

    rng = random.Random(4)
    rules = tuple(
        (tuple((rng.randrange(10), rng.random() < 0.5, rng.random() * 2) for _ in range(rng.randrange(1, 4))), rng.uniform(-1, 1))
        for _ in range(40)
    )
    model = quality.QualityModel(0.1, rules, quality.QualityParams())
    expected = []
    for text in texts:
        x = plain(text)
        total = 0.1 + sum(w for rule, w in rules if all((x[k] > limit) == above for k, above, limit in rule))
        expected.append(1 / (1 + math.exp(-total)))
    found = sorted(r.score for r in quality.score(frame, model).collect())
    assert found == pytest.approx(sorted(expected), abs=1e-12)
    assert quality.score(frame.limit(0), model).collect() == []


def test_lasso_reaches_the_least_loss():
    """At the least penalised loss every weight's slope equals the penalty, or is within it where the weight is 0."""
    rng = np.random.default_rng(1)
    holding = (rng.random((800, 25)) < 0.4).astype(np.float32)
    label = (rng.random(800) < 1 / (1 + np.exp(-(2 * holding[:, 0] - 3 * holding[:, 1] + 0.5)))).astype(float)
    params = quality.QualityParams(penalty=0.01, steps=3000)
    bias, weights = quality.lasso(holding, label, params)
    w = np.array(weights)
    slope = holding.T @ (1 / (1 + np.exp(-(holding @ w + bias))) - label) / len(label)
    free = np.abs(w) > 1e-6
    assert free[0] and free[1] and free.sum() < 15
    assert np.allclose(slope[free], -0.01 * np.sign(w[free]), atol=1e-4) and (np.abs(slope[~free]) <= 0.0101).all()


def test_toxic_class_on_held_out_rows(spark):
    """Most toxic rows are found, and few others: better than always answering 0."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    scored = entry_point.queries()["op3_toxicity_gru"](spark, folder)
    rows = [r for r in scored.collect() if r.held_out and labels.get(r.doc_id) is not None]
    toxic = [r for r in rows if labels[r.doc_id] == 1]
    clean = [r for r in rows if labels[r.doc_id] == 0]
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic) > 0
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)


@pytest.mark.parametrize(("text", "letter"), [("²³ ½ 12 _", False), ("²x", True), ("é", True), ("日", True), ("", False), ("٣ 🙂", False)])
def test_letters(text, letter):
    assert language.has_letter(text) is letter is any(c.isalpha() for c in text)


def test_language_model_equals_plain_counts(spark, docs):
    """Naive Bayes by hand, with a counter per language over the same n-grams."""
    import math

    params = language.LanguageParams(bits=12, sample_rows=10**6)
    model = language.train(docs, params)
    known = [r for r in docs.collect() if r.lang and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    counts, n_docs = defaultdict(Counter), Counter(r.lang for r in known)

    def buckets(text):
        return [b for found, _ in language._grams([text], params) for b in found.tolist()]

    for r in known:
        counts[r.lang].update(buckets(r.text or ""))
    assert model.languages == tuple(sorted(n_docs))
    tests = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2][:40]
    found = {r.doc_id: r for r in language.identify(docs, model).collect()}
    for r in tests:
        total = {}
        for lang in model.languages:
            mass = sum(counts[lang].values()) + params.smoothing * (1 << params.bits)
            total[lang] = math.log(n_docs[lang] / len(known)) + sum(
                math.log((counts[lang][b] + params.smoothing) / mass) for b in buckets(r.text)
            )
        best = max(total, key=total.get)
        assert found[r.doc_id].lang_pred == best
        share = 1 / sum(math.exp(x - total[best]) for x in total.values())
        assert found[r.doc_id].score == pytest.approx(share, abs=1e-3)


def test_chunks_travel_without_their_payload(spark):
    """What is exploded is a list of chunks; the payload isn't among the columns that go with each."""
    pages = spark.createDataFrame([(1, "u", "ab" * 100_000, 5)], "page_id bigint, url string, html string, n bigint")
    rows = warc.chunk_table(pages)
    generate = next(x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in x)
    # positions of the input that are dropped after the generator
    assert re.search(r"inline\(.*\), \[\d+\]|inline\(.*\), \[\d+, ", generate), generate
    found = sorted((r.chunk_no, bytes(r.chunk)) for r in rows.collect())
    assert b"".join(c for _, c in found) == b"ab" * 100_000 and [k for k, _ in found] == list(range(len(found)))
    assert warc.chunk_table(pages.limit(0)).collect() == []


def test_stages_on_empty_tables_and_clashing_names(spark, docs):
    """No documents give no rows at every stage; a column named like the row number stays as it is."""
    import corpus_pipeline

    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, empty, SF_DIR)
        assert found.collect() == []
        assert name == "packing" or found.columns == docs.columns
    text = " ".join(f"w{k}" for k in range(40))
    frame = spark.createDataFrame([(1, text, 7), (2, text, 8)], "doc_id bigint, text string, _row int")
    found = corpus_pipeline.drop_near_duplicates(spark, frame, SF_DIR)
    assert [tuple(r) for r in found.collect()] == [(1, text, 7)] and found.columns == frame.columns
