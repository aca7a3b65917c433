"""Quality classifier: a sparse ensemble of rules over text statistics, scored by Spark expressions.

The paths of shallow trees, from the root to every node, are conjunctive rules. A logistic
regression with an L1 penalty weighs them, which leaves few; these become one column.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from platewise.llm.common import fold, labelled_sample, once, saved

#: (statistic, whether above the threshold, threshold)
Condition = tuple[int, bool, float]
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class QualityParams:
    #: labelled documents of each class that are learnt from
    sample_rows: int = 4000
    trees: int = 20
    depth: int = 3
    #: strength of the L1 penalty
    penalty: float = 0.001
    #: steps of the fitting of the weights
    steps: int = 600
    seed: int = 7
    #: folds of crc32(doc_id), and the one that is never learnt from
    folds: int = 4
    held: int = 2
    threshold: float = 0.7


@dataclass(frozen=True)
class QualityModel:
    """Rules with their weights. Without rules the score is that of ``bias``."""

    bias: float
    rules: tuple[tuple[Rule, float], ...]
    params: QualityParams


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _measures(text: Column, words: Column) -> list[Column]:
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.size(words).cast("double")
    return [
        F.log1p(F.length(text).cast("double")),
        F.length(text) / n,
        F.size(F.array_distinct(words)) / n,
        (F.length(text) - _without(text, r"[#*$%&|<>]+")) / chars,
        _without(text, r"[^\p{Lu}]+") / chars,
        _without(text, r"[^0-9]+") / chars,
        _without(text, r"[^.,;:?]+") / n,
        _count(text, "!") / n,
        _count(text, "|") / n,
        _count(text, "\n") / n,
    ]


def measured(text: str, use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct with the statistics ``x0``, ``x1``, ... of a text; a null text counts as empty."""

    def of_text(own: Column) -> Column:
        words = F.split(own, r"[\x20\x09-\x0D]+")
        fields = lambda w: F.struct(*[v.alias(f"x{k}") for k, v in enumerate(_measures(own, w))])
        return once(words, lambda w: once(fields(w), use))

    return once(F.coalesce(text, F.lit("")), of_text)


def statistics(documents: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the columns ``keep`` and the statistics of each text as ``x0``, ``x1``, ...; null texts count as empty."""
    rows = documents.select("doc_id", *keep, measured("text", lambda s: s).alias("_statistics"))
    return rows.select("doc_id", *keep, "_statistics.*")


N_STATISTICS = 10
_BRANCH = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_rules(forest_text: str) -> list[Rule]:
    """Every path from a root to a node, read from a forest's printed form; equal paths once, in order."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, Condition]] = []
    for line in forest_text.splitlines():
        m = _BRANCH.match(line)
        if line.lstrip().startswith("Tree "):
            path = []
        elif m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (int(m[2]), m[3] == ">", float(m[4]))))
            found[tuple(sorted(c for _, c in path))] = None
    return list(found)


def holds(rule: Rule, row: Column | None = None) -> Column:
    """Whether the statistics, columns or fields of the struct ``row``, meet all conditions, as 0 or 1."""
    value = {k: F.col(f"x{k}") if row is None else row[f"x{k}"] for k, _, _ in rule}
    tests = [value[k] > limit if above else value[k] <= limit for k, above, limit in rule]
    return F.when(reduce(lambda a, b: a & b, tests), F.lit(1.0)).otherwise(F.lit(0.0))


def fired(rules: list[Rule], statistics: np.ndarray) -> np.ndarray:
    """Which rules hold for each row of statistics, as 0 or 1."""
    out = np.ones((len(statistics), len(rules)), np.float32)
    for column, rule in enumerate(rules):
        for k, above, limit in rule:
            out[:, column] *= (statistics[:, k] > limit) == above
    return out


def lasso(holding: np.ndarray, label: np.ndarray, params: QualityParams) -> tuple[float, list[float]]:
    """Bias and weights with the least mean logistic loss plus ``penalty`` times the weights' absolute sum.

    Accelerated proximal gradient steps, their size the inverse of the loss's curvature at
    most; the bias isn't penalised. The sample is bounded, so this is work for one machine.
    """
    x = np.column_stack([np.ones(len(label), np.float32), holding])
    # the largest eigenvalue by repeated products, with room for what they miss
    v = np.full(x.shape[1], x.shape[1] ** -0.5, np.float32)
    for _ in range(30):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    step = 4 * len(label) / (1.05 * float(np.linalg.norm(x @ v)) ** 2)
    w = ahead = np.zeros(x.shape[1])
    speed = 1.0
    for _ in range(params.steps):
        z = x @ ahead.astype(np.float32)
        p = 0.5 * np.tanh(0.5 * z) + 0.5
        moved = ahead - step * (x.T @ (p - label).astype(np.float32)) / len(label)
        after = np.sign(moved) * np.maximum(np.abs(moved) - step * params.penalty, 0)
        after[0] = moved[0]
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        ahead = after + (speed - 1) / faster * (after - w)
        w, speed = after, faster
    return float(w[0]), w[1:].tolist()


def train(documents: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Fit on a bounded sample of labelled documents outside the held-out fold.

    The sample's statistics are written to the work folder once; the fitting iterates over
    these few rows: the trees in Spark, the weights on the driver. With labels of one class only every score is that class, without any
    labels 0.5.
    """
    ids = labelled_sample(labels, "quality", params.folds, params.held, params.sample_rows)
    # at most 2 * sample_rows ids: a bounded side
    chosen = documents.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    known = statistics(chosen).join(F.broadcast(ids), "doc_id")
    known = known.withColumn("label", F.col("label").cast("double"))
    # scanned by as many tasks as the corpus has splits; only the sampled rows are dealt anew
    known = saved(known.repartition(8), "quality-sample")
    classes = sorted(r[0] for r in known.select("label").distinct().collect())
    if len(classes) < 2:
        return QualityModel({(): 0.0, (0.0,): -20.0, (1.0,): 20.0}[tuple(classes)], (), params)
    rows = known.withColumn("features", array_to_vector(F.array(*[f"x{k}" for k in range(N_STATISTICS)])))
    forest = RandomForestClassifier(
        numTrees=params.trees, maxDepth=params.depth, featureSubsetStrategy="sqrt", seed=params.seed
    ).fit(rows.select("features", "label"))
    rules = tree_rules(forest.toDebugString)
    if not rules:
        share = sum(classes) / len(classes)
        return QualityModel(0.0 if share == 0.5 else 20.0, (), params)
    # at most 2 * sample_rows rows of ten numbers and a label
    sample = known.select("label", *[f"x{k}" for k in range(N_STATISTICS)]).toPandas().to_numpy(dtype=float)
    # summed in one order, whatever the partitions
    sample = sample[np.lexsort(sample.T)]
    bias, weights = lasso(fired(rules, sample[:, 1:]), sample[:, 0], params)
    kept = tuple((r, w) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6)
    return QualityModel(bias, kept, params)


def score_column(model: QualityModel, text: str = "text") -> Column:
    """The rules compiled into one expression over the statistics of a text, which it computes once: a probability."""

    def probability(row: Column) -> Column:
        total = reduce(lambda a, b: a + b, [holds(r, row) * F.lit(w) for r, w in model.rules], F.lit(model.bias))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    return measured(text, probability)


def score(documents: DataFrame, model: QualityModel, *keep: str) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` in 0 to 1 and ``predicted``; no Python runs on the rows.

    Null and empty texts are scored by their statistics, as texts of length 0. Repeated
    rows and ids are scored each by itself; a null id counts as not held out. Columns other
    than ``doc_id``, ``text`` and ``keep``, which comes with each row, are not read.
    """
    params = model.params
    scored = documents.select("doc_id", *keep, score_column(model).alias("score"))
    return scored.select(
        "doc_id",
        *keep,
        F.coalesce(fold("doc_id", params.folds) == params.held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"),
    )
