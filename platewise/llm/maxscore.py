"""Exact top-k search by inner product with MaxScore over postings.

A vector's dimensions are its terms, a shard of candidates holds a list of postings per
term. For a query, terms are split by their score bounds: as long as the bounds of some
terms together stay below the k-th best score, a candidate that has these terms only can't
get in. These non-essential terms are only probed, and only for candidates that can still
reach the k-th best score; the postings of the others are traversed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from platewise.llm.common import record


@dataclass(frozen=True)
class SearchParams:
    k: int = 5
    #: rows whose id is divisible by this are the queries
    every: int = 50
    #: candidates of a shard, queries of a block (about: both are dealt by hash)
    shard_rows: int = 4096
    block_rows: int = 4096
    #: candidates traversed before there is a k-th best score, and before it is renewed
    first: int = 256
    stride: int = 2048
    #: terms probed between two checks of what is still competitive
    probe: int = 4


def quantized(vector: Column) -> Column:
    """``floor(256 * x)`` of every component, null unless all are finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.when(whole, F.transform(x, lambda v: F.floor(F.lit(256.0) * v).cast("bigint")))


class Shard:
    """Candidates in order of their ids, with a list of postings (row, value) per term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: int = 1 << 31) -> None:
        """``largest``: no component of a query is larger. Floats are faster, and exact as long as they hold all sums."""
        order = np.argsort(ids, kind="stable")
        reach = int(np.abs(vectors).max(initial=0)) * largest * max(vectors.shape[1], 1)
        vectors = vectors.astype(np.float32 if reach < 1 << 24 else float) if reach < 1 << 53 else vectors
        self.ids, self.vectors = ids[order], vectors[order]
        self.rows = [np.flatnonzero(column) for column in self.vectors.T]
        self.values = [column[rows] for column, rows in zip(self.vectors.T, self.rows, strict=True)]
        #: terms that every candidate has: their postings are columns
        self.dense = np.array([len(rows) == len(ids) for rows in self.rows], bool)
        self.columns = np.ascontiguousarray(self.vectors.T)
        self.most = self.vectors.max(axis=0, initial=0)
        self.least = self.vectors.min(axis=0, initial=0)


def search(shard: Shard, query: np.ndarray, own: int, params: SearchParams) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates other than ``own``, best first, ties to the smaller id."""
    query = query.astype(shard.columns.dtype)
    bounds = np.maximum(query * shard.most, query * shard.least)
    order = np.argsort(bounds, kind="stable")
    sums = np.cumsum(bounds[order])
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, shard.columns.dtype)
    limit = None
    starts = [0, *range(params.first, len(shard.ids), params.stride)]
    for start, stop in zip(starts, [*starts[1:], len(shard.ids)], strict=True):
        spare = 0 if limit is None else int(np.searchsorted(sums, limit))
        score = np.zeros(stop - start, shard.columns.dtype)
        met = np.zeros(stop - start, bool) if spare else np.ones(stop - start, bool)
        here = shard.columns[:, start:stop]
        essential = order[spare:]
        for term in essential[shard.dense[essential]].tolist():
            score += query[term] * here[term]
            met[:] = True
        for term in essential[~shard.dense[essential]]:
            if query[term]:
                rows = shard.rows[term]
                a, b = np.searchsorted(rows, (start, stop))
                at = rows[a:b] - start
                score[at] += query[term] * shard.values[term][a:b]
                met[at] = True
        met[shard.ids[start:stop] == own] = False
        alive = np.flatnonzero(met)
        for last in range(spare, 0, -1):
            if (spare - last) % params.probe == 0:
                alive = alive[score[alive] + sums[last - 1] >= limit]
                if not len(alive):
                    break
            term = order[last - 1]
            if 4 * len(alive) > len(score):
                score += query[term] * here[term]
            else:
                score[alive] += query[term] * here[term][alive]
        if limit is not None:
            alive = alive[score[alive] >= limit]
        if len(alive):
            found = np.concatenate([best, score[alive]])
            ids = np.concatenate([best_ids, shard.ids[start + alive]])
            top = np.lexsort((ids, -found))[: params.k]
            best, best_ids = found[top], ids[top]
            if len(best) == params.k:
                limit = best[-1]
    return best_ids, best.astype(np.int64)


def top_k(embeddings: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best candidates of each query.

    Null vectors, and those with null or non-finite components, take no part, nor do null
    ids. Vectors of different lengths are filled up with zeros. A query never finds rows of
    its own id; among candidates every row counts for itself. Rows of a query's id with the
    same vector are one query, with other vectors further queries with ranks of their own.
    Products and sums are 64-bit: components up to 2 to the 27 are safe. Without queries or
    candidates the result is empty. Other columns are not read.
    """
    vectors = embeddings.select("vec_id", quantized(F.col("embedding")).alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    )
    wanted = F.col("vec_id") % params.every == 0
    sizes = vectors.agg(F.count("*").alias("n"), F.count(F.when(wanted, 1)).alias("queries")).first()
    shards = max(1, -(-sizes["n"] // params.shard_rows))
    blocks = max(1, -(-sizes["queries"] // params.block_rows))

    def dealt(column: str, parts: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int").alias(column)

    def each(column: str, parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(column)

    candidates = vectors.select("vec_id", "v", dealt("shard", shards, 1)).select(
        "*", each("block", blocks)
    )
    queries = vectors.filter(wanted).distinct().select("vec_id", "v", dealt("block", blocks, 2))
    queries = queries.select("*", each("shard", shards))
    schema = "query_id bigint, vector bigint, vec_id bigint, score bigint"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids, asked = _matrix(left)
        ids, found = _matrix(right)
        width = max(asked.shape[1], found.shape[1])
        shard = Shard(ids, _wide(found, width), int(np.abs(asked).max(initial=1)))
        out: list[tuple] = []
        for at, (own, query) in enumerate(zip(query_ids.tolist(), _wide(asked, width), strict=True)):
            near, score = search(shard, query, own, params)
            out.append((own, at, near, score))
        n = [len(o[2]) for o in out]
        hashes = left.column("vector").to_numpy()
        values = {
            "query_id": np.repeat(query_ids, n),
            "vector": np.repeat(hashes, n),
            "vec_id": np.concatenate([o[2] for o in out]) if out else [],
            "score": np.concatenate([o[3] for o in out]) if out else [],
        }
        return pa.Table.from_batches([record(schema, values)])

    queries = queries.withColumn("vector", F.xxhash64("v"))
    key = ("shard", "block")
    found = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(run, schema)
    # the shards' results are merged: at most k rows of each shard per query
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= params.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.column("vec_id").to_numpy()
    vectors = rows.column("v").combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks) if vectors.num_chunks else pa.array([], vectors.type)
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return ids, out


def _wide(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
