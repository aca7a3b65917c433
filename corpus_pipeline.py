"""From raw documents to packed training sequences, stage by stage.

Every stage gets all documents that the one before kept, as Parquet in the shared work
folder, and returns the columns of ``documents``; the last returns pieces of sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import bpe, ngram_join, packing, pii, quality, toxicity
from platewise.llm.common import saved, table
from platewise.llm.queries import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose most toxic window reaches the threshold go. Null and empty texts stay."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules score below the threshold go. Null and empty texts are scored as texts of length 0."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_column(model) >= model.params.threshold)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts one row stays, that with the smallest id; a null id comes last.

    Rows are linked by a number of their own, written with them once, whatever their ids.
    Rows without words are in no component: one of each id stays, and all without an id.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = saved(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    linked = ngram_join.link(rows.select(F.col(row).alias("doc_id"), "text")).withColumnRenamed("doc_id", row)
    blank = F.col("n_shingles") == 0
    groups = [
        F.when(~blank | F.col("doc_id").isNull(), F.col("component_id")).alias("component"),
        F.when(blank, F.col("doc_id")).alias("blank_id"),
    ]
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first")
    stay = linked.join(rows.select(row, "doc_id"), row).groupBy(*groups).agg(first).select(f"first.{row}")
    return rows.join(stay, row, "left_semi").select(*docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become the names of their kinds."""
    return pii.mask_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, bpe.load(vocabulary_path()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("packing", pack_sequences),
]

#: the stages learn models and tokenize: SQL can't express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; what lies between them is written to the shared work folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
