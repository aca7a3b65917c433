"""Keyed merges: the result is a new DataFrame, written as a new table version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructField

from platewise.operators.dedup import top_per_key

# The columns each warehouse table takes from a row that is already there.
DIM_RESTAURANT_UPDATES = [
    "name",
    "address",
    "rating",
    "total_ratings",
    "price_level",
    "types",
    "updated_at",
]
FACT_REVIEW_UPDATES = ["rating", "review_text", "review_age_days", "loaded_at"]
FACT_PREDICTION_UPDATES = [
    "predicted_score",
    "sentiment_label",
    "confidence",
    "model_version",
    "predicted_at",
]


def row_order(df: DataFrame, key: str) -> list[Column]:
    """An order of rows by all columns but the key; values that can't be compared, as maps, by their JSON text."""

    def comparable(field: StructField) -> Column:
        return F.col(field.name) if isinstance(field.dataType, AtomicType) else F.to_json(F.struct(field.name))

    return [comparable(f) for f in df.schema if f.name != key] or [F.col(key)]


def merge_by_key(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    update_cols: Sequence[str] | None = None,
    order_by: Sequence[Column] | None = None,
    keep_if_null: bool = False,
    op_col: str | None = None,
    small_updates: bool = False,
) -> DataFrame:
    """Insert rows with a new key, change ``update_cols`` of rows with a known key.

    ``order_by`` picks the winner among updates of one key (first row wins); without it
    the smallest row by the other columns wins, so copies in a batch never multiply a
    key, whatever their order. ``keep_if_null`` treats a null in an
    update as "field not sent". ``op_col`` adds what happened to each row: inserted,
    modified, unchanged (matched without a new value) or kept (no update).

    The default is one full outer join. ``small_updates`` suits a batch far smaller than
    the target: the target is only ever the outer side of joins with the batch, so where
    Spark finds the batch below its broadcast threshold the target is not shuffled, at
    the price of a second scan of its key column. Both give the same rows.
    """
    order_by = row_order(updates, key) if order_by is None else order_by
    updates = top_per_key(updates, [key], order_by)
    update_cols = [c for c in updates.columns if c != key] if update_cols is None else update_cols
    sent = updates.select(
        key, F.lit(True).alias("_sent"), *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c != key]
    )
    marked = target.withColumn("_known", F.lit(True))
    if small_updates:
        matched_keys = target.select(key).join(sent.select(key), key, "left_semi")
        new_rows = sent.join(matched_keys, key, "left_anti")
        joined = marked.join(sent, key, "left").unionByName(new_rows, allowMissingColumns=True)
    else:
        joined = marked.join(sent, key, "full_outer")
    known, matched = F.col("_known").isNotNull(), F.col("_known") & F.col("_sent")

    columns: dict[str, Column] = {}
    changed = F.lit(False)
    for name in [*target.columns, *[c for c in updates.columns if c not in target.columns]]:
        if name == key:
            columns[name] = F.col(key)
            continue
        old = F.col(name) if name in target.columns else F.lit(None)
        if name not in updates.columns:
            columns[name] = old
            continue
        new = F.col(f"_new_{name}")
        if name in target.columns and isinstance(target.schema[name].dataType, AtomicType):
            new = new.cast(target.schema[name].dataType)
        if name in update_cols:
            value = F.coalesce(new, old) if keep_if_null else new
            if op_col:
                changed = changed | ~value.eqNullSafe(old)
            columns[name] = F.when(matched, value).when(known, old).otherwise(new)
        else:
            columns[name] = F.when(known, old).otherwise(new)
    if op_col:
        columns[op_col] = (
            F.when(~known, "inserted")
            .when(F.col("_sent").isNull(), "kept")
            .when(changed, "modified")
            .otherwise("unchanged")
        )
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def merge_counts(merged: DataFrame, op_col: str) -> DataFrame:
    """One row: how many rows a merge inserted and modified."""
    return merged.agg(
        F.count_if(F.col(op_col) == "inserted").alias("inserted"),
        F.count_if(F.col(op_col) == "modified").alias("modified"),
    )


def insert_if_absent(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Add rows whose key is new, one per key; rows already there stay as they are."""
    unique = top_per_key(updates, [key], row_order(updates, key))
    return target.unionByName(unique.join(target.select(key), key, "left_anti"), allowMissingColumns=True)


def upsert_reviews(target, updates, order_by=None, op_col=None) -> DataFrame:
    """Review documents: every field that was sent wins, the others stay."""
    return merge_by_key(target, updates, "review_id", None, order_by, keep_if_null=True, op_col=op_col)


upsert_processed = upsert_reviews


def upsert_restaurants(target, updates, order_by=None, op_col=None) -> DataFrame:
    return merge_by_key(target, updates, "place_id", None, order_by, keep_if_null=True, op_col=op_col)


def upsert_preferences(
    target: DataFrame, submitted: DataFrame, order_by=None, updated_at: Column | None = None
) -> DataFrame:
    """Stored preferences per user, with the defaults of fields that were not sent, and when they were sent.

    What a user sends replaces all their preferences: a price range that isn't sent is none.
    """
    filled = submitted.withColumns(
        {
            "user_id": F.coalesce("user_id", F.lit("anonymous")),
            "cuisine_types": F.coalesce("cuisine_types", F.array().cast("array<string>")),
            "min_rating": F.coalesce("min_rating", F.lit(3.0)),
            "updated_at": F.current_timestamp() if updated_at is None else updated_at,
        }
    )
    if "price_range" not in filled.columns:
        filled = filled.withColumn("price_range", F.lit(None).cast("array<int>"))
    return merge_by_key(target, filled, "user_id", None, order_by)


def upsert_recommendations(target: DataFrame, docs: DataFrame) -> DataFrame:
    """Stored lists per user; a new list replaces the old one as a whole."""
    return merge_by_key(target, docs, "user_id")


def merge_dim_restaurants(target, updates, order_by=None, op_col=None) -> DataFrame:
    """Known places keep their coordinates."""
    return merge_by_key(target, updates, "place_id", DIM_RESTAURANT_UPDATES, order_by, op_col=op_col)


def merge_fact_reviews(target, updates, order_by=None, op_col=None) -> DataFrame:
    """Known reviews keep author, place, length, words and date."""
    sent = [F.col(c) for c in ("review_text", "text_cleaned") if c in updates.columns]
    updates = updates.withColumn("review_text", F.coalesce(*sent, F.lit("")))
    if "text_cleaned" in updates.columns:
        updates = updates.drop("text_cleaned")
    return merge_by_key(target, updates, "review_id", FACT_REVIEW_UPDATES, order_by, op_col=op_col)


def split_by_reference(rows: DataFrame, referenced: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key exists in ``referenced``, and the rest."""
    keys = referenced.select(key)
    return rows.join(keys, key, "left_semi"), rows.join(keys, key, "left_anti")


def merge_fact_predictions(target, predictions, fact_reviews, order_by=None, op_col=None) -> DataFrame:
    """Predictions of loaded reviews only; known predictions keep their place."""
    valid, _ = split_by_reference(predictions, fact_reviews, "review_id")
    return merge_by_key(target, valid, "review_id", FACT_PREDICTION_UPDATES, order_by, op_col=op_col)
