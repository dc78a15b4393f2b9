"""Single-label flow: examples to a table of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexiloom.functions.vectors import reject_nan
from lexiloom.operators.decode import predicted_label, predicted_label_index, predicted_probability
from lexiloom.operators.prepare import union_train_test
from lexiloom.operators.score import batch_score
from lexiloom.operators.train import Model, train_single_label
from lexiloom.schemas import SINGLE_LABEL_PREDICTIONS, Splits, conform


def decode_single_label(scored: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(text, label, is_train, probabilities) to the prediction table.

    The label is chosen on the rounded scores; they are narrowed to float at the end.
    """
    sound = scored.withColumn("probabilities", reject_nan("probabilities")).withColumnRenamed("label", "label_indx")
    chosen = predicted_label_index(predicted_probability(sound))
    named = predicted_label(predicted_label(chosen, labels), labels, "label_indx", "label")
    return conform(named, SINGLE_LABEL_PREDICTIONS, keep)


def single_label_predictions(
    train: DataFrame, test: DataFrame, labels: DataFrame, model: Model, key: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Score train and test with one model and decode the result; nothing passes through the driver."""
    return decode_single_label(batch_score(union_train_test(train, test), model, key=key), labels, keep)


def train_and_predict(
    splits: Splits, outputs: int, vocabulary_size: int | None = None, smoothing: float = 1.0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The whole flow: fit on train, predict train and test."""
    model = train_single_label(splits.train, outputs, vocabulary_size, smoothing)
    return single_label_predictions(splits.train, splits.test, splits.labels, model, keep=keep)


def score_texts(
    texts: DataFrame, labels: DataFrame, model: Model, text: str = "text", key: str | None = None
) -> DataFrame:
    """Label and score of any table of texts, with a ready model."""
    scored = batch_score(texts, model, text, key)
    scored = predicted_label_index(predicted_probability(scored.withColumn("probabilities", reject_nan("probabilities"))))
    named = predicted_label(scored, labels, name="label_name")
    return named.select(
        *texts.columns, F.col("label_name"), F.col("predicted_probability").cast("float").alias("score")
    )
