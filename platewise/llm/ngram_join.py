"""Near-duplicate documents: Jaccard join on word n-grams by token-combination prefixes.

A token is the 64-bit hash of an n-gram; a document is its set of tokens. Tokens are
ordered by class, rare before frequent, then by number. A set's prefix is as long as it
takes for two similar sets to share, in some class, as many prefix tokens as that class
combines: one for the rare class, two for each class of frequent tokens. Sets that share a
combination are candidates and are verified exactly.

Why this loses no link. Let x have n tokens; a similar set has at least ``ceil(t * n)`` of
them, so at most ``m = n - ceil(t * n)`` of x's tokens are missing in it. Of two similar
sets, take the one whose prefix ends first. All its prefix tokens that are shared lie in
the other's prefix too. If they shared fewer than k tokens in each class of k-combinations,
at least ``sum(max(0, count - (k - 1)))`` of its prefix tokens would be missing; the prefix
is extended until that sum is above m.

Frequent tokens are dealt to as many classes as an eighth of the set's size, so that a set
has about as many pairs as tokens. Two similar sets can differ in size, and so in their
number of classes: a set also emits the pairs of the next scheme if a similar set can be
in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from platewise.llm.common import map_text, raw_text, record, saved_and_freed, slices
from platewise.llm.graph import components
from platewise.llm.words import LOWER, PLACES, hash_runs, mixed, ramp, windows, words

#: a block's bits are sent to the driver as a row, which should not be much smaller than its other fields
LEAST_BLOCK_BITS = 10


@dataclass(frozen=True)
class JoinParams:
    shingle: int = 5
    #: similarity of links, in percent
    percent: int = 75
    #: tokens are counted in ``2 ** slot_bits`` slots; raise it with the corpus
    slot_bits: int = 27
    #: slots are summed in blocks of at most ``2 ** block_bits``, and at least as many blocks as the session's shuffle partitions
    block_bits: int = 20
    #: a token is frequent if its slot counts so many documents, and four times as many as the block's mean
    frequent: int = 16
    #: tokens of a group of candidates that are verified in one task
    task_tokens: int = 1 << 20


def with_blocks(params: JoinParams, partitions: int) -> JoinParams:
    """The parameters with blocks so small that each of the partitions has one to sum."""
    most = params.slot_bits - (max(partitions, 1) - 1).bit_length()
    return replace(params, block_bits=max(LEAST_BLOCK_BITS, min(params.block_bits, most)))


def missing(n: int, percent: int) -> int:
    """How many of a set's ``n`` tokens a similar set may lack."""
    return n + (-percent * n) // 100


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct tokens of every text: hashes of its windows of ``size`` words.

    A text of fewer words has one token for all of them, a text without words none.
    """
    low = LOWER[data]
    found, inside = words(low, bounds)
    hashes = hash_runs(low[inside], found.ends - found.starts)
    tokens, at = windows(hashes, found, size)
    firsts = np.searchsorted(at, found.first)
    out = []
    for k, n in enumerate(found.per_text.tolist()):
        if n >= size:
            out.append(np.unique(tokens[firsts[k] : firsts[k + 1]]))
        elif n:
            own = hashes[found.first[k] : found.first[k + 1]]
            with np.errstate(over="ignore"):
                out.append(mixed((own * PLACES[8 : 8 + n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(tokens: np.ndarray) -> int:
    """A 64-bit number of a set."""
    with np.errstate(over="ignore"):
        own = mixed(tokens + np.uint64(0x9E3779B97F4A7C15)).sum(keepdims=True) + np.uint64(len(tokens))
    return int(mixed(own).view(np.int64)[0])


# --- frequent tokens -----------------------------------------------------------------


def frequent_slots(documents: DataFrame, params: JoinParams) -> bytes:
    """One bit per slot: whether the tokens of all documents that fall into it are frequent.

    Tasks send the slots of their documents' tokens, block by block; each block is summed
    in an array of a fixed size. The bits, ``2 ** slot_bits / 8`` bytes whatever the size
    of the corpus, are put together by the driver.
    """
    blocks = 1 << (params.slot_bits - params.block_bits)
    schema = "block int, slots binary"
    flush = 1 << 21

    def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
        slots = np.sort(np.concatenate(parts))
        edges = np.searchsorted(slots, np.arange(blocks + 1, dtype=np.uint64) << np.uint64(params.block_bits))
        some = np.flatnonzero(np.diff(edges))
        low = np.uint64((1 << params.block_bits) - 1)
        # steps between sorted slots are small numbers, which compress well
        steps = [np.diff(slots[edges[b] : edges[b + 1]] & low, prepend=np.uint64(0)).astype(np.uint32) for b in some]
        return record(schema, {"block": some, "slots": [s.tobytes() for s in steps]})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in slices(batch):
                for own in shingles(*raw_text(part.column("text")), params.shingle):
                    parts.append(own >> np.uint64(64 - params.slot_bits))
                    held += len(own)
                if held >= flush:
                    yield emit(parts)
                    parts, held = [], 0
        if held:
            yield emit(parts)

    sums = "block int, bits binary"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << params.block_bits, np.int32)
        block = 0
        for batch in batches:
            for b, data in zip(batch.column("block").to_pylist(), batch.column("slots").to_pylist(), strict=True):
                block = b
                at = np.cumsum(np.frombuffer(data, np.uint32), dtype=np.int64)
                place, times = np.unique(at, return_counts=True)
                total[place] += times.astype(np.int32)
        limit = max(params.frequent, 4 * (int(total.sum()) >> params.block_bits))
        yield record(sums, {"block": [block], "bits": [np.packbits(total >= limit).tobytes()]})

    rows = documents.select("text").mapInArrow(send, schema).groupBy("block").applyInArrow(add, sums).collect()
    return _joined_bits(rows, params)


def _joined_bits(rows: list, params: JoinParams) -> bytes:
    bits = np.zeros((1 << (params.slot_bits - params.block_bits), (1 << params.block_bits) // 8), np.uint8)
    for r in rows:
        bits[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return bits.tobytes()


# --- prefixes ------------------------------------------------------------------------


def scheme(n: int) -> int:
    """The scheme of classes of a set of ``n`` tokens: grows by one when the size doubles."""
    return max(0, n.bit_length() - 4)


def schemes(n: int, percent: int) -> list[int]:
    """The own scheme, and the next one if a larger similar set can have it."""
    own = scheme(n)
    return [own, own + 1] if scheme(100 * n // percent) > own else [own]


def signatures(rare: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """The combinations of a set's prefix as 64-bit numbers; both arrays of tokens are sorted."""
    n = len(rare) + len(often)
    need = missing(n, percent) + 1
    found = [rare[:need]]
    if len(rare) < need:
        for kind in schemes(n, percent):
            found.append(_pairs(often, need - len(rare), kind))
    return np.unique(np.concatenate(found))


def _pairs(often: np.ndarray, need: int, kind: int) -> np.ndarray:
    """Pairs within classes of the shortest prefix of frequent tokens that lacks one token per class and still has ``need``."""
    group = (mixed(often) % np.uint64(1 << kind)).astype(np.int64)
    # a class's first token adds nothing to what the prefix secures
    first = np.zeros(len(often), bool)
    first[np.unique(group, return_index=True)[1]] = True
    secured = np.cumsum(~first)
    length = int(np.searchsorted(secured, need)) + 1
    own, group = often[:length], group[:length]
    out = []
    for g in np.unique(group):
        t = own[group == g]
        i, j = np.triu_indices(len(t), 1)
        with np.errstate(over="ignore"):
            out.append(mixed(t[i] * PLACES[0] + t[j] * PLACES[1] + np.uint64(kind + 1)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


# --- the join ------------------------------------------------------------------------


def link(documents: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``class_id`` (smallest id of an equal set).

    A null text, and one without words, has no shingles and is linked with nothing, itself
    aside. Equal sets are one node of the search, so copies of a document cost no pairs.
    Rows that share an id are one document to the links. Rows with a null id are left out,
    as they can't name a component. Other columns are not read.
    """
    params = with_blocks(params, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    documents = documents.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    bits = frequent_slots(documents, params)
    sets = saved_and_freed(_signed(documents, bits, params), "signatures")
    nodes = sets.filter("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n"), F.first("parities").alias("parities")
    )
    nodes = saved_and_freed(nodes, "nodes")
    groups = saved_and_freed(_possible(nodes, _candidates(sets), params), "candidates")
    linked = components(_verified(documents, nodes, groups, params))
    named = nodes.join(linked, nodes["class_id"] == linked["node"], "left").select(
        nodes["node"], "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    out = sets.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def _signed(documents: DataFrame, bits: bytes, params: JoinParams) -> DataFrame:
    """Per document the size and number of its set, and the set's combinations.

    Of equal sets that a task meets in one batch only the first carries combinations.
    """
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def work(part: pa.RecordBatch) -> dict[str, object]:
        table = np.frombuffer(shared.value, np.uint8)
        seen: set[int] = set()
        nodes, sizes, found, maps = [], [], [], []
        for own in shingles(*raw_text(part.column("text")), params.shingle):
            node = fingerprint(own)
            nodes.append(node)
            sizes.append(len(own))
            maps.append(parities(own))
            # one or two tokens can only be similar to an equal set
            if len(own) < 3 or node in seen:
                found.append(np.zeros(0, np.int64))
                continue
            seen.add(node)
            slot = (own >> np.uint64(64 - params.slot_bits)).astype(np.int64)
            often = (table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0
            found.append(signatures(own[~often], own[often], params.percent).view(np.int64))
        return {
            "doc_id": part.column("doc_id"),
            "node": nodes,
            "n_shingles": sizes,
            "parities": maps,
            "signatures": pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32),
                pa.array(np.concatenate(found)),
            ),
        }

    schema = "doc_id bigint, node bigint, n_shingles bigint, parities binary, signatures array<bigint>"
    return map_text(documents, ["doc_id"], work, schema)


def _candidates(sets: DataFrame) -> DataFrame:
    """(``head``, ``node``): all sets that share a combination, under the smallest of them, itself included.

    Every two sets that share a combination meet under its head. A combination's sets are
    never brought together, as a list or in one task: smallest and largest are found by a
    partial aggregate, and what they say of shared combinations is written, so that both
    sides of the join are plain shuffles, which adaptive execution splits where a group is large.
    """
    rows = sets.select(F.explode("signatures").alias("signature"), "node")
    ends = rows.groupBy("signature").agg(F.min("node").alias("head"), F.max("node").alias("top"))
    heads = saved_and_freed(ends.filter("head < top").select("signature", "head"), "heads")
    return rows.join(heads, "signature").select("head", "node").distinct()


def _sized(groups: DataFrame, nodes: DataFrame, tokens: int) -> DataFrame:
    """The groups with ``n``, a set's size, and ``large``: whether a group's sets have more than ``tokens`` tokens."""
    members = groups.join(nodes.select("node", "n"), "node")
    large = members.groupBy("head").agg((F.sum("n") > tokens).alias("large"))
    return members.join(large, "head")


def _dealt(members: DataFrame, near: DataFrame, tokens: int) -> DataFrame:
    """Tasks (``head``, ``i``, ``j``) with their nodes, so that every two of a group meet that need to.

    ``near`` lists the nodes of large groups that were compared with their head and are
    near it. Two of these needn't meet. So the others are dealt to blocks of about
    ``tokens`` tokens, and so are the near ones; every two blocks make a task, but no two
    of near ones. A small group is one task.
    """
    marked = members.join(near.select("head", "node", F.lit(True).alias("near")), ["head", "node"], "left")
    marked = marked.withColumn("near", F.coalesce("near", F.lit(False)))

    def blocks(chosen: Column) -> Column:
        return F.ceil(F.coalesce(F.sum(F.when(chosen, F.col("n"))), F.lit(0)) / F.lit(float(tokens))).cast("int")

    counted = marked.groupBy("head").agg(blocks(~F.col("near")).alias("others"), blocks(F.col("near")).alias("nears"))
    deal = F.xxhash64("node", F.lit(1))
    dealt = marked.join(counted.filter("others > 0"), "head").select(
        "head",
        "node",
        F.when(F.col("near"), F.col("others") + F.pmod(deal, F.col("nears")))
        .otherwise(F.pmod(deal, F.col("others")))
        .cast("int")
        .alias("own"),
        F.explode(
            F.sequence(F.lit(0), F.col("others") - 1 + F.when(F.col("near"), F.lit(0)).otherwise(F.col("nears")))
        ).alias("other"),
    )
    return dealt.select("head", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node")


def _possible(nodes: DataFrame, groups: DataFrame, params: JoinParams) -> DataFrame:
    """The groups without what the parities rule out: (``head``, ``node``), parts of groups that can hang together.

    Bits of parity are a sixty-fourth of a set, so this moves little; after it few sets
    have to be moved that aren't similar to any. What may be similar to the head of a large
    group is such a part.
    """
    schema = "head bigint, node bigint"
    percent = params.percent

    def sift(table: pa.Table) -> pa.Table:
        ids = np.array(table.column("node").to_pylist(), np.int64)
        heads = hang_together(ids, table.column("n").to_numpy(), table.column("parities").to_pylist(), percent)
        keep = np.flatnonzero(np.isin(heads, heads[heads != ids]))
        return pa.Table.from_batches([record(schema, {"head": heads[keep], "node": ids[keep]})])

    def near_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(*(batch.column(c).to_pylist() for c in ("n", "parities", "head_n", "head_parities")), strict=True)
            hit = pa.array([may_be_similar(*pair, percent) for pair in own], pa.bool_())
            yield batch.select(["head", "node"]).filter(hit)

    # parities are small: larger groups fit in a task
    tokens = 16 * params.task_tokens
    members = _sized(groups, nodes, tokens)
    known = nodes.select("node", "n", "parities")
    of_heads = known.toDF("head", "head_n", "head_parities")
    large = members.filter("large").select("head", "node").join(known, "node").join(of_heads, "head")
    near = saved_and_freed(large.mapInArrow(near_head, schema), "near_heads")
    rows = _dealt(members, near, tokens).join(known, "node")
    return rows.groupBy("head", "i", "j").applyInArrow(sift, schema).unionByName(near).distinct()


def may_be_similar(n: int, own: bytes, m: int, other: bytes, percent: int) -> bool:
    """Whether sizes and parities let two sets be similar."""
    if 100 * n < percent * m or 100 * m < percent * n:
        return False
    bits = [np.frombuffer(x, np.uint64) for x in (own, other)]
    both = min(len(x) for x in bits)
    apart = int(np.bitwise_count(_folded(bits[0], both) ^ _folded(bits[1], both)).sum(dtype=np.int64))
    shared = (n + m - apart) // 2
    return 100 * shared >= percent * (n + m - shared)


def parities(tokens: np.ndarray) -> bytes:
    """One bit for each slot: whether an odd number of tokens falls into it. There are about as many slots as tokens."""
    size = max(256, 1 << max(len(tokens) - 1, 1).bit_length())
    place = (mixed(tokens) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=size) & 1).astype(bool), bitorder="little").tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Parities for fewer slots, by joining the slots that become one."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def hang_together(ids: np.ndarray, sizes: np.ndarray, maps: list[bytes], percent: int) -> np.ndarray:
    """For each set the smallest id that it can be joined to by links, as far as parities tell.

    Sets whose parities differ in d slots differ in d tokens at least, so they share at
    most half of what their sizes together have beyond d.
    """
    bits = [np.frombuffer(m, np.uint64) for m in maps]
    widths = np.array([len(b) for b in bits])
    by_width = {w: (np.flatnonzero(widths == w), np.stack([b for b in bits if len(b) == w])) for w in set(widths.tolist())}
    row = np.zeros(len(ids), np.int64)
    for at, _ in by_width.values():
        row[at] = np.arange(len(at))
    heads = ids.copy()
    left = np.ones(len(ids), bool)
    for start in np.argsort(ids, kind="stable"):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            at = todo.pop()
            for w, (members, stack) in by_width.items():
                # similar sizes are at most one doubling apart
                if not (widths[at] <= 2 * w and w <= 2 * widths[at]):
                    continue
                near = members[left[members]]
                near = near[(100 * sizes[near] >= percent * sizes[at]) & (100 * sizes[at] >= percent * sizes[near])]
                if not len(near):
                    continue
                both = min(w, int(widths[at]))
                apart = np.bitwise_count(_folded(stack[row[near]], both) ^ _folded(bits[at], both)).sum(axis=1, dtype=np.int64)
                total = sizes[near] + sizes[at]
                shared = (total - apart) // 2
                found = near[100 * shared >= percent * (total - shared)]
                heads[found] = ids[start]
                left[found] = False
                todo += found.tolist()
    return heads


def _wanted(ids: DataFrame, params: JoinParams) -> bytes:
    """One bit per slot of an id's hash: whether an id falls into it. Of a fixed size, like the bits of frequent tokens."""
    schema = "block int, bits binary"

    def mark(table: pa.Table) -> pa.Table:
        here = np.zeros(1 << params.block_bits, bool)
        here[table.column("place").to_numpy()] = True
        block = table.column("block")[0].as_py()
        return pa.Table.from_batches([record(schema, {"block": [block], "bits": [np.packbits(here).tobytes()]})])

    slots = ids.select(_id_slot("class_id", params).alias("slot")).select(
        F.shiftright("slot", params.block_bits).cast("int").alias("block"),
        F.col("slot").bitwiseAND((1 << params.block_bits) - 1).alias("place"),
    )
    return _joined_bits(slots.distinct().groupBy("block").applyInArrow(mark, schema).collect(), params)


def _id_slot(column: str, params: JoinParams):
    return F.shiftrightunsigned(F.xxhash64(column), 64 - params.slot_bits)


def _verified(documents: DataFrame, nodes: DataFrame, groups: DataFrame, params: JoinParams) -> DataFrame:
    """Links ``a``, ``b`` (class ids) that join what is similar among the sets of each group.

    The sets are made again from the texts, of the documents whose ids are in a group; the
    bits that say so let a few others through, which find no task in the join. A large
    group is linked to its head first.
    """
    wanted = groups.select("node").distinct().join(nodes, "node").select("class_id")
    shared = documents.sparkSession.sparkContext.broadcast(_wanted(wanted, params))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            hit = (table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0
            for part in slices(batch.filter(pa.array(hit))):
                yield _sets(part, params)

    texts = documents.select("doc_id", "text", _id_slot("doc_id", params).alias("slot"))
    sets = texts.mapInArrow(tokens, SETS)
    links = "a bigint, b bigint"

    def verify(table: pa.Table) -> pa.Table:
        # a row that is repeated in the documents is the same set again
        ids, at = np.unique(table.column("class_id").to_numpy(), return_index=True)
        own = [np.frombuffer(t, np.uint64) for t in table.column("tokens").take(pa.array(at)).to_pylist()]
        a, b = similar(ids.tolist(), own, params.percent)
        return pa.Table.from_batches([record(links, {"a": a, "b": b})])

    named = nodes.select("node", "class_id")
    members = _sized(groups, nodes, params.task_tokens)
    near = saved_and_freed(_near_heads(documents, named, members.filter("large").select("head", "node"), params), "near")
    tasks = _dealt(members, near, params.task_tokens).join(named, "node")
    rows = tasks.join(sets, ["node", "class_id"])
    found = rows.groupBy("head", "i", "j").applyInArrow(verify, links)
    return found.unionByName(near.filter("a != b").select("a", "b"))


SETS = "node bigint, class_id bigint, tokens binary"


def _sets(part: pa.RecordBatch, params: JoinParams) -> pa.RecordBatch:
    """The sets of texts, with their numbers and the documents' ids."""
    found = shingles(*raw_text(part.column("text")), params.shingle)
    out = {
        "node": [fingerprint(own) for own in found],
        "class_id": part.column("doc_id"),
        "tokens": [own.tobytes() for own in found],
    }
    return record(SETS, out)


def _near_heads(documents: DataFrame, named: DataFrame, large: DataFrame, params: JoinParams) -> DataFrame:
    """(``head``, ``node``, ``a``, ``b``): the nodes of large groups that are similar to their head, and both class ids.

    A head's set travels with each of its nodes, which doubles what the group moves; no
    other two sets of the group meet here.
    """
    schema = "head bigint, node bigint, a bigint, b bigint"
    large = saved_and_freed(large, "large_groups")
    ids = large.select(F.explode(F.array("head", "node")).alias("node")).distinct().join(named, "node")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _sets(part, params)

    texts = documents.join(ids.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi")
    sets = texts.select("doc_id", "text").mapInArrow(tokens, SETS).join(ids, ["node", "class_id"], "left_semi")
    sets = saved_and_freed(sets.dropDuplicates(["node", "class_id"]), "large_sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, heads = (batch.column(c).to_pylist() for c in ("tokens", "head_tokens"))
            hit = [_similar_pair(x, y, params.percent) for x, y in zip(own, heads, strict=True)]
            yield batch.select(["head", "node", "a", "b"]).filter(pa.array(hit, pa.bool_()))

    of_heads = sets.toDF("head", "a", "head_tokens")
    pairs = large.join(sets.withColumnRenamed("class_id", "b"), "node").join(of_heads, "head")
    return pairs.mapInArrow(compare, schema)


def _similar_pair(own: bytes, other: bytes, percent: int) -> bool:
    a, b = np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def similar(ids: list[int], sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """Links enough to connect what is similar, directly or by way of others.

    From a set, all sets not yet reached are compared with it at once, then the same from
    each set reached. Sets already in the same component aren't compared again.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    firsts = np.cumsum(sizes) - sizes
    distinct, token = np.unique(np.concatenate(sets), return_inverse=True)
    # for each token the sets that hold it
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(token, kind="stable")]
    held = np.bincount(token, minlength=len(distinct))
    first_holder = np.cumsum(held) - held
    order = np.argsort(np.array(ids), kind="stable")
    left = order[sizes[order] > 0]
    a: list[int] = []
    b: list[int] = []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = left[(100 * sizes[left] >= percent * sizes[at]) & (100 * sizes[at] >= percent * sizes[left])]
            if not len(near):
                continue
            own = token[firsts[at] : firsts[at] + sizes[at]]
            if held[own].sum() < 2 * sizes[near].sum():
                met = holders[np.repeat(first_holder[own], held[own]) + ramp(held[own])]
                both = np.bincount(met, minlength=len(sets))[near]
            else:
                mark = np.zeros(len(distinct), bool)
                mark[own] = True
                hit = mark[token[np.repeat(firsts[near], sizes[near]) + ramp(sizes[near])]]
                both = np.add.reduceat(hit, np.cumsum(sizes[near]) - sizes[near], dtype=np.int64)
            linked = near[100 * both >= percent * (sizes[near] + sizes[at] - both)]
            a += [ids[at]] * len(linked)
            b += [ids[k] for k in linked]
            todo += linked.tolist()
            left = left[~np.isin(left, linked)]
    return a, b
