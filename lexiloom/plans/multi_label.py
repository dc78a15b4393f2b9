"""Multi-label flow: examples to a table of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lexiloom.functions.vectors import reject_nan
from lexiloom.operators.decode import index_names, threshold_indices, true_indices
from lexiloom.operators.prepare import union_train_test
from lexiloom.operators.score import batch_score
from lexiloom.operators.train import Model, train_multi_label
from lexiloom.schemas import MULTI_LABEL_PREDICTIONS, Splits, conform


def decode_multi_label(
    scored: DataFrame, labels: DataFrame, keep: tuple[str, ...] = (), key: str | None = None
) -> DataFrame:
    """(text, labels, is_train, probabilities) to the prediction table."""
    chosen = true_indices(threshold_indices(scored.withColumn("probabilities", reject_nan("probabilities"))))
    renamed = chosen.withColumnsRenamed({"labels": "all_label_indxs", "probabilities": "pred_proba_label_indxs"})
    named = index_names(renamed, labels, "predicted_label_indxs", "predicted_labels", key)
    named = index_names(named, labels, "label_indxs", "labels", key)
    return conform(named, MULTI_LABEL_PREDICTIONS, keep)


def multi_label_predictions(
    train: DataFrame, test: DataFrame, labels: DataFrame, model: Model, key: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Score train and test with one model and decode the result; nothing passes through the driver."""
    scored = batch_score(union_train_test(train, test), model, key=key)
    return decode_multi_label(scored, labels, keep, key)


def train_and_predict(
    splits: Splits, outputs: int, vocabulary_size: int | None = None, smoothing: float = 1.0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The whole flow: fit on train, predict train and test."""
    model = train_multi_label(splits.train, outputs, vocabulary_size, smoothing)
    return multi_label_predictions(splits.train, splits.test, splits.labels, model, keep=keep)
