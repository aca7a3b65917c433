"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of an embedding of the whole word and the mean embedding of its
character n-grams, both hashed into tables of a fixed size. Every overlapping window of
words is scored; a document's score is that of its most toxic window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import fold, labelled_sample, map_text, raw_text, slices
from platewise.llm.words import LOWER, Runs, hash_runs, mixed, ramp, runs

#: bytes of words: ASCII letters and digits, apostrophe, and all beyond ASCII
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 0x27, *range(0x80, 256)]] = True

Weights = dict[str, np.ndarray]

#: distinct words whose n-grams are worked on at once
AT_ONCE = 1 << 14


@dataclass(frozen=True)
class ToxicityParams:
    window: int = 32
    #: half a window: a passage of up to 16 words lies whole in some window
    stride: int = 16
    word_bits: int = 13
    char_bits: int = 13
    char_sizes: tuple[int, ...] = (3, 4)
    dim: int = 8
    hidden: int = 8
    attention: int = 8
    #: labelled documents of each class that are learnt from, each with all of its windows
    sample_rows: int = 1200
    rounds: int = 6
    batch: int = 256
    #: steps of learning per round at least, whatever the size of the sample
    least_steps: int = 60
    rate: float = 0.02
    seed: int = 7
    #: folds of crc32(doc_id), and the one that is never learnt from
    folds: int = 3
    held: int = 1
    threshold: float = 0.7


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` is None if there was nothing to learn from; then every score is 0."""

    weights: Weights | None
    params: ToxicityParams


# --- words and windows ---------------------------------------------------------------


@dataclass
class Vocab:
    """Distinct words of a batch: bucket of each, its character n-grams' buckets and where they start."""

    word: np.ndarray
    grams: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def read_words(data: np.ndarray, bounds: np.ndarray, params: ToxicityParams) -> tuple[Vocab, np.ndarray, Runs]:
    """The distinct words, which of them each word is, and the words of each text."""
    low = LOWER[data]
    inside = _WORD[low]
    found = runs(inside, bounds)
    sizes = found.ends - found.starts
    hashes = hash_runs(low[inside], sizes)
    distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    word = (distinct >> np.uint64(64 - params.word_bits)).astype(np.int32)
    starts, sizes, buckets, counts = found.starts[at], sizes[at], [], []
    for k in range(0, len(at), AT_ONCE):
        some, first = _grams(low, starts[k : k + AT_ONCE], sizes[k : k + AT_ONCE], params)
        buckets.append(some)
        counts.append(np.diff(first))
    if not buckets:
        return Vocab(word, np.zeros(0, np.int32), np.zeros(1, np.int64)), which, found
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return Vocab(word, np.concatenate(buckets), first), which, found


def _grams(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray, params: ToxicityParams):
    # each word between two marks, one after another
    wide = sizes + 2
    place = ramp(wide)
    owner = np.repeat(np.arange(len(wide)), wide)
    edge = (place == 0) | (place == wide[owner] - 1)
    source = np.minimum(starts[owner] + np.maximum(place - 1, 0), max(len(low) - 1, 0))
    content = np.where(edge, np.uint64(1), low[source].astype(np.uint64) + np.uint64(2))
    owners, buckets = [], []
    with np.errstate(over="ignore"):
        for n in params.char_sizes:
            m = len(content) - n + 1
            if m <= 0:
                continue
            h = np.full(m, np.uint64(n))
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + content[k : k + m]
            at = np.flatnonzero(place[:m] + n <= wide[owner[:m]])
            owners.append(owner[at])
            buckets.append((mixed(h[at]) >> np.uint64(64 - params.char_bits)).astype(np.int32))
    if not owners:
        return np.zeros(0, np.int32), np.zeros(len(sizes) + 1, np.int64)
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(sizes) + 1))


def windows_of(counts: np.ndarray, params: ToxicityParams) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word (within the text) of every window: one each ``stride`` words until all words are in one."""
    n = np.where(
        counts > params.window, 1 + -(-(counts - params.window) // params.stride), (counts > 0).astype(np.int64)
    )
    return np.repeat(np.arange(len(counts)), n), ramp(n) * params.stride


def window_words(
    which: np.ndarray, found: Runs, text: np.ndarray, first: np.ndarray, params: ToxicityParams
) -> np.ndarray:
    """A row of distinct words per window, -1 beyond the text's end."""
    at = (found.first[text] + first)[:, None] + np.arange(params.window)
    ok = at < found.first[text + 1][:, None]
    return np.where(ok, which[np.minimum(at, max(len(which) - 1, 0))], -1)


# --- the network ---------------------------------------------------------------------


def initial(params: ToxicityParams) -> Weights:
    rng = np.random.default_rng(params.seed)
    d, h, a = params.dim, params.hidden, params.attention

    def some(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    weights = {
        "word": some(1 << params.word_bits, d, scale=0.1),
        "char": some(1 << params.char_bits, d, scale=0.1),
        "attend": some(2 * h, a, scale=0.4),
        "attend_bias": np.zeros(a, np.float32),
        "query": some(a, scale=0.4),
        "out": some(2 * h, scale=0.4),
        "out_bias": np.zeros(1, np.float32),
    }
    for side in ("forth", "back"):
        weights[f"{side}_in"] = some(d, 3 * h, scale=d**-0.5)
        weights[f"{side}_state"] = some(h, 3 * h, scale=h**-0.5)
        weights[f"{side}_bias"] = np.zeros(3 * h, np.float32)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def embed(vocab: Vocab, w: Weights) -> np.ndarray:
    """The input of every distinct word, and zeros for the place after a text's end."""
    x = np.zeros((len(vocab.word) + 1, w["word"].shape[1]), np.float32)
    for k in range(0, len(vocab.word), AT_ONCE):
        x[k : min(k + AT_ONCE, len(vocab.word))] = w["word"][vocab.word[k : k + AT_ONCE]]
        first = vocab.first[k : k + AT_ONCE + 1]
        some = np.flatnonzero(np.diff(first))
        if len(some):
            sums = np.add.reduceat(w["char"][vocab.grams[first[0] : first[-1]]], first[some] - first[0], axis=0)
            x[k + some] += sums / np.diff(first)[some, None].astype(np.float32)
    return x


def _run(gates: np.ndarray, at: np.ndarray, real: np.ndarray, w: Weights, side: str, keep: bool):
    """States of one direction (steps, windows, hidden), and what the way back needs."""
    h = w[f"{side}_state"].shape[0]
    steps = at.shape[1]
    state = np.zeros((len(at), h), np.float32)
    states = np.zeros((steps, len(at), h), np.float32)
    saved = []
    places = np.ascontiguousarray(at.T)
    full = real.all(axis=0)
    for t in range(steps) if side == "forth" else range(steps - 1, -1, -1):
        g = np.take(gates, places[t], axis=0)
        s = state @ w[f"{side}_state"]
        zr = g[:, : 2 * h] + s[:, : 2 * h]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        z, r = zr[:, :h], zr[:, h:]
        new = r * s[:, 2 * h :]
        new += g[:, 2 * h :]
        np.tanh(new, out=new)
        after = state - new
        after *= z
        after += new
        ok = real[:, t, None]
        if not full[t]:
            after = np.where(ok, after, state)
        if keep:
            saved.append((t, state, z, r, new, s[:, 2 * h :], ok))
        state = after
        states[t] = state
    return states, saved


def forward(x: np.ndarray, at: np.ndarray, w: Weights, keep: bool = False):
    """The logit of every window; ``at`` holds rows of ``x``, -1 where a window has no word."""
    real = at >= 0
    both, saved = [], []
    for side in ("forth", "back"):
        gates = x @ w[f"{side}_in"] + w[f"{side}_bias"]
        states, kept = _run(gates, at, real, w, side, keep)
        both.append(states)
        saved.append(kept)
    states = np.concatenate(both, axis=2)
    hidden = np.tanh(states @ w["attend"] + w["attend_bias"])
    score = np.where(real.T, hidden @ w["query"], np.float32(-1e9))
    share = np.exp(score - score.max(axis=0))
    share /= share.sum(axis=0)
    pooled = np.einsum("tn,tnk->nk", share, states)
    logit = pooled @ w["out"] + w["out_bias"][0]
    return (logit, (real, states, hidden, share, pooled, saved)) if keep else logit


def gradients(x: np.ndarray, at: np.ndarray, w: Weights, y: np.ndarray) -> tuple[float, Weights, np.ndarray]:
    """Mean loss, gradients of the weights, and of every row of ``x``."""
    logit, (real, states, hidden, share, pooled, saved) = forward(x, at, w, keep=True)
    p = _sigmoid(logit)
    loss = float(-np.mean(np.where(y > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7))))
    d_logit = ((p - y) / len(y)).astype(np.float32)
    g: Weights = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * w["out"]
    d_states = share[:, :, None] * d_pooled
    d_share = np.einsum("tnk,nk->tn", states, d_pooled)
    d_score = share * (d_share - (share * d_share).sum(axis=0))
    g["query"] = np.einsum("tn,tna->a", d_score, hidden)
    d_hidden = d_score[:, :, None] * w["query"] * (1 - hidden * hidden)
    g["attend"] = np.einsum("tnk,tna->ka", states, d_hidden)
    g["attend_bias"] = d_hidden.sum(axis=(0, 1))
    d_states += d_hidden @ w["attend"].T
    h = w["forth_state"].shape[0]
    d_x = np.zeros_like(x)
    for side, part, kept in (("forth", d_states[:, :, :h], saved[0]), ("back", d_states[:, :, h:], saved[1])):
        d_x += _run_back(x, at, w, side, part, kept, g)
    return loss, g, d_x


def _run_back(x: np.ndarray, at: np.ndarray, w: Weights, side: str, d_states: np.ndarray, saved: list, g: Weights):
    h = d_states.shape[2]
    u = w[f"{side}_state"]
    d_u = np.zeros_like(u)
    d_gates = np.zeros((len(x), 3 * h), np.float32)
    d_state = np.zeros(d_states.shape[1:], np.float32)
    for t, before, z, r, new, inner, ok in reversed(saved):
        d_after = d_state + d_states[t]
        d_here = np.where(ok, d_after, 0)
        d_z = d_here * (before - new) * z * (1 - z)
        d_new = d_here * (1 - z) * (1 - new * new)
        d_r = d_new * inner * r * (1 - r)
        d_s = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_u += before.T @ d_s
        np.add.at(d_gates, at[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
        d_state = np.where(ok, d_here * z, d_after) + d_s @ u.T
    d_gates[-1] = 0
    g[f"{side}_state"] = d_u
    g[f"{side}_bias"] = d_gates.sum(axis=0)
    g[f"{side}_in"] = x.T @ d_gates
    return d_gates @ w[f"{side}_in"].T


class Adam:
    def __init__(self, w: Weights, rate: float) -> None:
        self.rate, self.steps = rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in w.items()}
        self.square = {k: np.zeros_like(v) for k, v in w.items()}

    def step(self, w: Weights, g: Weights) -> None:
        self.steps += 1
        scale = self.rate * (1 - 0.999**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        for k, grad in g.items():
            m, s = self.mean[k], self.square[k]
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            w[k] -= (scale * m / (np.sqrt(s) + 1e-8)).astype(np.float32)


def fit(vocab: Vocab, at: np.ndarray, bag: np.ndarray, label: np.ndarray, params: ToxicityParams) -> Weights:
    """Learn from windows ``at`` of documents ``bag`` with labels by document.

    A document's label is known, not which of its windows earn it. The first round takes
    every fourth window; later rounds take the windows that the network so far holds most
    toxic: one of each toxic document, two of each other.
    """
    w = initial(params)
    rng = np.random.default_rng(params.seed)
    adam = Adam(w, params.rate)
    y = label[bag].astype(np.float32)
    for turn in range(params.rounds):
        if turn == 0:
            chosen = np.flatnonzero((np.arange(len(at)) % 4 == 0) | np.isin(bag, np.flatnonzero(np.bincount(bag) < 4)))
        else:
            logit = all_logits(vocab, at, w)
            order = np.lexsort((-logit, bag))
            place = ramp(np.bincount(bag, minlength=len(label)))
            chosen = order[place < np.where(y[order] > 0, 1, 2)]
        parts = max(1, len(chosen) // params.batch)
        for _ in range(max(1 if turn == 0 else 3, -(-params.least_steps // parts))):
            for rows in np.array_split(rng.permutation(chosen), parts):
                _learn(vocab, at[rows], y[rows], w, adam)
        adam.rate *= 0.75
    return w


def _learn(vocab: Vocab, at: np.ndarray, y: np.ndarray, w: Weights, adam: Adam) -> None:
    used, inverse = np.unique(at, return_inverse=True)
    inverse = inverse.reshape(at.shape)
    if used[0] == -1:  # the empty place stays the last row
        used, inverse = used[1:], inverse - 1
    counts = vocab.counts[used]
    grams = vocab.grams[np.repeat(vocab.first[used], counts) + ramp(counts)]
    own = Vocab(vocab.word[used], grams, np.concatenate([[0], np.cumsum(counts)]))
    _, g, d_x = gradients(embed(own, w), inverse, w, y)
    d_x = d_x[:-1]
    for name, place, rows in (
        ("word", own.word, d_x),
        ("char", grams, np.repeat(d_x / np.maximum(counts, 1)[:, None], counts, axis=0)),
    ):
        g[name] = np.zeros_like(w[name])
        np.add.at(g[name], place, rows.astype(np.float32))
    adam.step(w, g)


def all_logits(vocab: Vocab, at: np.ndarray, w: Weights, rows: int = 2048) -> np.ndarray:
    x = embed(vocab, w)
    parts = []
    for k in range(0, len(at), rows):
        # gates are worked out for the words of these windows only; -1 stays the last row
        used, own = np.unique(at[k : k + rows], return_inverse=True)
        own = own.reshape(-1, at.shape[1]) - (used[0] == -1)
        parts.append(forward(x[np.append(used[used >= 0], -1)], own, w))
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


# --- on tables -----------------------------------------------------------------------


def train(documents: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Fit on a bounded sample of labelled documents outside the held-out fold.

    The driver receives the whole texts of at most ``2 * sample_rows`` labelled ids and
    cuts them into all of their windows.
    """
    ids = labelled_sample(labels, "toxic", params.folds, params.held, params.sample_rows)
    # at most 2 * sample_rows ids: a bounded side
    sample = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter(F.col("text").isNotNull())
    rows = sample.select("doc_id", "label", "text").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
    if len(rows["label"].unique()) < 2:
        return ToxicityModel(None, params)
    found_docs, doc = np.unique(rows["doc_id"].to_numpy(), return_inverse=True)
    label = np.zeros(len(found_docs), np.int64)
    label[doc] = rows["label"].to_numpy()
    data, bounds = raw_text(pa.concat_arrays(rows["text"].cast(pa.large_string()).chunks))
    del rows
    pa.default_memory_pool().release_unused()
    vocab, which, found = read_words(data, bounds, params)
    del data
    which = which.astype(np.int32)
    text, first = windows_of(found.per_text, params)
    at = [
        window_words(which, found, text[k : k + 8192], first[k : k + 8192], params).astype(np.int32)
        for k in range(0, len(text), 8192)
    ]
    if not at:
        return ToxicityModel(None, params)
    return ToxicityModel(fit(vocab, np.concatenate(at), doc[text], label, params), params)


def _most_toxic(part: pa.RecordBatch, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the score of its most toxic window, and the number of its windows."""
    best = np.zeros(part.num_rows)
    data, bounds = raw_text(part.column("text"))
    vocab, which, found = read_words(data, bounds, model.params)
    text, first = windows_of(found.per_text, model.params)
    if model.weights is not None and len(text):
        at = window_words(which, found, text, first, model.params)
        np.maximum.at(best, text, _sigmoid(all_logits(vocab, at, model.weights).astype(float)))
    return best, np.bincount(text, minlength=part.num_rows)


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` in 0 to 1, ``predicted`` and ``n_windows``.

    A null text, and one without a letter or digit, has no window and score 0. Repeated
    rows and ids are scored each by itself; a null id counts as not held out; other columns
    are not read. The model has a fixed size and is broadcast.
    """
    params = model.params
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> dict[str, object]:
        best, n = _most_toxic(part, shared.value)
        return {"doc_id": part.column("doc_id"), "score": best, "n_windows": n}

    out = map_text(documents, ["doc_id"], work, "doc_id bigint, score double, n_windows bigint")
    held = F.coalesce(fold("doc_id", params.folds) == params.held, F.lit(False))
    predicted = (F.col("score") >= params.threshold).cast("int")
    return out.select(
        "doc_id", held.alias("held_out"), "score", predicted.alias("predicted"), "n_windows"
    )


def drop_toxic(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold; each is decided by its own text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch):
                stays = _most_toxic(part, shared.value)[0] < shared.value.params.threshold
                yield batch.slice(at, part.num_rows).filter(pa.array(stays))
                at += part.num_rows

    return documents.mapInArrow(run, documents.schema)
