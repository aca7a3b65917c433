"""Review scoring with a pluggable five-class model.

A model is a function ``(df, text_col) -> df`` that adds an array column ``logits`` of
five numbers per row; it may return null for a row it cannot judge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from platewise.functions import sentiment, text
from platewise.functions.numbers import exact_mean, round_half_up

Model = Callable[[DataFrame, str], DataFrame]


def score_from_logits(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Score, label and confidence from the class logits."""
    raw = F.col(logits)
    return df.withColumns(
        {
            "predicted_score": sentiment.expected_score(raw),
            "sentiment_label": sentiment.top_label(raw),
            "confidence": sentiment.confidence(raw),
        }
    )


def score_reviews(
    reviews: DataFrame,
    model: Model,
    model_name: str,
    predicted_at: Column | None = None,
    text_col: str = "text",
) -> DataFrame:
    """Add prediction columns and key phrases to reviews.

    A review without any text after normalisation is neutral with confidence 0.
    """
    normalized = reviews.withColumn("text_cleaned", text.normalize_text(F.col(text_col)))
    scored = score_from_logits(model(normalized, "text_cleaned"))
    empty = (F.col("text_cleaned") == "") | F.col("logits").isNull()
    return scored.withColumns(
        {
            "predicted_score": F.when(empty, 3.0).otherwise(F.col("predicted_score")),
            "sentiment_label": F.when(empty, "neutral").otherwise(F.col("sentiment_label")),
            "confidence": F.when(empty, 0.0).otherwise(F.col("confidence")),
            "model_version": F.lit(sentiment.model_version(model_name)),
            "predicted_at": F.current_timestamp() if predicted_at is None else predicted_at,
            "key_phrases": text.key_phrases(F.col("text_cleaned")),
        }
    ).drop("logits")


def ensure_scored(
    reviews: DataFrame, model: Model, model_name: str, predicted_at: Column | None = None
) -> DataFrame:
    """Score only the reviews without a score; the others keep theirs.

    A kept score may name its label ``sentiment``; its missing confidence counts as 0.
    """
    label = [F.col(c) for c in ("sentiment_label", "sentiment") if c in reviews.columns]
    ready = reviews.filter(F.col("predicted_score").isNotNull()).withColumns(
        {
            "sentiment_label": F.coalesce(*label),
            "confidence": F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)),
            "predicted_score": F.col("predicted_score").cast("double"),
        }
    )
    stale = {"predicted_score", "sentiment_label", "sentiment", "confidence", "model_version"}
    missing = reviews.filter(F.col("predicted_score").isNull())
    missing = missing.drop(*[c for c in missing.columns if c in stale])
    return ready.unionByName(
        score_reviews(missing, model, model_name, predicted_at), allowMissingColumns=True
    )


def batch_summary(scored: DataFrame) -> DataFrame:
    """Mean score and confidence of a scored batch; NULL for an empty one."""
    return scored.agg(
        F.count(F.lit(1)).alias("review_count"),
        round_half_up(exact_mean(F.col("predicted_score"), 3), 2).alias("avg_score"),
        round_half_up(exact_mean(F.col("confidence"), 4), 3).alias("avg_confidence"),
    )


def stored_logits(table: DataFrame, key: str, logits: str) -> Model:
    """A model whose outputs were computed elsewhere and are looked up by key."""

    def apply(df: DataFrame, text_col: str) -> DataFrame:
        outputs = table.select(key, F.col(logits).alias("logits"))
        return df.join(outputs, key, "left")

    return apply


def batch_model(load: Callable[[], Callable[[list[str]], np.ndarray]], batch_size: int = 32) -> Model:
    """A Python model that maps a list of texts to an ``(n, 5)`` array of logits.

    ``load`` runs once per Python worker and task, not per batch; empty texts are not
    sent to the model.
    """

    @F.pandas_udf(ArrayType(DoubleType()))
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for texts in batches:
            filled = texts[texts.fillna("") != ""]
            judged = []
            for start in range(0, len(filled), batch_size):
                part = filled.iloc[start : start + batch_size]
                judged.extend(np.asarray(predict(part.tolist()), dtype=float))
            answers = iter(judged)
            yield pd.Series([next(answers) if t else None for t in texts.fillna("")], index=texts.index, dtype=object)

    return lambda df, text_col: df.withColumn("logits", logits(F.col(text_col)))


def train_bag_of_words(
    rated: DataFrame,
    text_col: str = "text",
    rating_col: str = "rating",
    features: int = 1 << 14,
    max_iter: int = 20,
) -> Model:
    """Default model: multinomial logistic regression on hashed words, trained on ratings.

    The fitted weights are ``features x 5`` numbers whatever the size of the data.
    Classes 0..5 are kept and class 0, which no rating has, is cut off.
    """
    training = rated.filter(F.col(rating_col).isNotNull()).select(
        text.normalize_text(F.col(text_col)).alias("_words_text"),
        F.round(sentiment.clamp_rating(F.col(rating_col))).alias("_label"),
    )
    stages = Pipeline(
        stages=[
            RegexTokenizer(inputCol="_words_text", outputCol="_words", pattern=r"\s+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
            IDF(inputCol="_counts", outputCol="_features"),
            LogisticRegression(
                featuresCol="_features",
                labelCol="_label",
                rawPredictionCol="_raw",
                probabilityCol="_probability",
                predictionCol="_prediction",
                family="multinomial",
                regParam=0.05,
                maxIter=max_iter,
            ),
        ]
    )
    fitted = stages.fit(training)
    classes = fitted.stages[-1].numClasses

    def apply(df: DataFrame, new_text_col: str) -> DataFrame:
        out = fitted.transform(df.withColumn("_words_text", F.col(new_text_col)))
        raw = vector_to_array("_raw")
        # an absent class gets a logit low enough to have no weight
        logits = F.array(*[raw[i] if i < classes else F.lit(-1e3) for i in range(1, 6)])
        return out.withColumn("logits", logits).drop(
            "_words_text", "_words", "_counts", "_features", "_raw", "_probability", "_prediction"
        )

    return apply
