"""The three entry points over catalog tables: store and profile a dataset, train on it, predict it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexiloom.config import (
    EVAL_BATCH, INFERENCE_BATCH, MAX_LENGTH, MULTI_LABEL, TRAIN_BATCH, Dataset,
)
from lexiloom.operators import profile
from lexiloom.operators.evaluate import METRICS, metrics_for
from lexiloom.operators.runs import append_run, merged, rates, read_runs, run_row, stored_mb, timed_write
from lexiloom.operators.score import add_logits
from lexiloom.operators.staging import fresh_path, settle
from lexiloom.operators.train import train_multi_label, train_single_label
from lexiloom.plans.multi_label import multi_label_predictions
from lexiloom.plans.single_label import single_label_predictions
from lexiloom.schemas import Splits
from lexiloom.sources.models import load_model, model_path, save_model
from lexiloom.sources.readers import read_table
from lexiloom.sources.writers import replace_table, save_table


def store(splits: Splits, info: Dataset, fmt: str = "parquet", folder: str | None = None) -> None:
    """Save the train, test and label tables; with ``folder`` their files live below it."""
    for name, df in ((info.train, splits.train), (info.test, splits.test), (info.labels, splits.labels)):
        save_table(df, name, fmt, f"{folder.rstrip('/')}/{name}" if folder else None)


def read_splits(spark: SparkSession, info: Dataset) -> Splits:
    return Splits(*(read_table(spark, name) for name in (info.train, info.test, info.labels)))


def describe(spark: SparkSession, info: Dataset) -> dict[str, DataFrame]:
    """Record counts, lengths and their quantiles, and train texts that leak into test."""
    splits = read_splits(spark, info)
    # Three of the results come from it.
    histogram = settle(profile.length_histogram(profile.token_lengths(splits.train)))
    return {
        "row_counts": profile.row_counts(splits._asdict()),
        "histogram": profile.order_by_length(histogram),
        "quartiles": profile.histogram_quantiles(histogram, profile.QUARTILES),
        "deciles": profile.histogram_quantiles(histogram, profile.DECILES),
        "leaked": profile.leaked_rows(splits.train, splits.test),
    }


def train_run(
    spark: SparkSession,
    info: Dataset,
    run_id: str,
    models: str,
    runs: str,
    vocabulary_size: int | None = None,
    smoothing: float = 1.0,
) -> DataFrame:
    """Fit on train, evaluate on test, keep the model and append the run to the runs table."""
    splits = read_splits(spark, info)
    multi = info.problem_type == MULTI_LABEL
    fit = train_multi_label if multi else train_single_label
    fitted = []

    def write_model() -> None:
        fitted.append(fit(splits.train, info.num_labels, vocabulary_size, smoothing))
        save_model(fitted[0], run_id, models)

    train_seconds = timed_write(write_model)
    label = "labels" if multi else "label"
    scored = add_logits(splits.test, load_model(spark, models, run_id, info.problem_type))
    measured = fresh_path(spark, "metrics")
    metrics = metrics_for(scored.select(label, "logits"), info.problem_type)
    eval_seconds = timed_write(lambda: metrics.write.parquet(measured))
    best = spark.read.parquet(measured).first()
    counts = {row["split"]: row["n_rows"] for row in profile.row_counts(splits._asdict()).collect()}
    run = run_row(
        spark,
        run_id,
        merged(
            {"dataset": info.name, "num_labels": info.num_labels, "problem_type": info.problem_type},
            {"feature_col": "text", "inference_batch_size": INFERENCE_BATCH, "max_length": MAX_LENGTH},
            {"per_device_train_batch_size": TRAIN_BATCH, "per_device_eval_batch_size": EVAL_BATCH},
            {"vocabulary_size": vocabulary_size, "smoothing": smoothing},
        ),
        merged(
            {name: round(best[name], 4) for name in METRICS},
            {"model_size_mb": stored_mb(spark, model_path(models, run_id))},
            rates("train", train_seconds, counts.get("train", 0), TRAIN_BATCH),
            rates("eval", eval_seconds, counts.get("test", 0), EVAL_BATCH),
        ),
    )
    append_run(run, runs)
    return run


def choose_run(spark: SparkSession, runs: str, info: Dataset) -> str:
    """The run of this dataset with the greatest f1, the first by name on ties."""
    table = read_runs(spark, runs).where(F.col("params.dataset") == info.name)
    best = table.orderBy(F.col("metrics.f1").desc_nulls_last(), "run_id").first()
    if best is None:
        raise ValueError(f"no run of {info.name} at {runs}")
    return best["run_id"]


def predict_run(
    spark: SparkSession, info: Dataset, run_id: str, models: str, fmt: str = "parquet", path: str | None = None
) -> DataFrame:
    """Score train and test with a run's model and replace the dataset's predictions table."""
    splits = read_splits(spark, info)
    model = load_model(spark, models, run_id, info.problem_type)
    predict = multi_label_predictions if info.problem_type == MULTI_LABEL else single_label_predictions
    replace_table(predict(splits.train, splits.test, splits.labels, model), info.predictions, fmt, path)
    return read_table(spark, info.predictions)
