"""Metric logs and tables of training runs."""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from lexiloom.config import EARLY_STOP_PATIENCE, EARLY_STOP_THRESHOLD, SCORE_DIGITS
from lexiloom.schemas import RUNS

LOSS, EVAL = "loss", "eval"

# Evaluation measures that do not go into the best-epoch metrics.
DROPPED_EVAL_METRICS = ["eval_runtime", "eval_samples_per_second", "eval_steps_per_second", "step"]


def timed_write(write: Callable[[], None]) -> float:
    """Seconds a write takes; a DataFrame does nothing before its write."""
    start = time.perf_counter()
    write()
    return time.perf_counter() - start


def observed_write(df: DataFrame, path: str, **measures: Column) -> tuple[dict, float]:
    """Write ``df`` as Parquet; returns aggregates of its rows and the seconds it took.

    The aggregates are collected by the tasks that write, so nothing is read again.
    """
    seen = Observation()
    watched = df.observe(seen, *[measure.alias(name) for name, measure in measures.items()])
    seconds = timed_write(lambda: watched.write.mode("overwrite").parquet(path))
    return dict(seen.get), seconds


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(files, bytes): one row about the data files below a path; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.col("path").endswith(".parquet")).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def stored_mb(spark: SparkSession, path: str) -> float:
    """Megabytes of the files of a written table."""
    return round(stored_files(spark, path).first()["bytes"] / (1024 * 1024), 1)


def rates(prefix: str, seconds: float, rows: int, batch_size: int, epochs: int = 1) -> dict[str, float]:
    """Duration, rows and throughput of a step; training is told in minutes, the rest in seconds."""
    steps = -(-rows // batch_size) * epochs
    safe = max(seconds, 1e-9)
    if prefix == "train":
        return {
            "train_minutes": round(seconds / 60, 2),
            "train_samples_per_second": round(rows * epochs / safe, 1),
            "train_steps_per_second": round(steps / safe, 2),
            "train_rows": float(rows),
        }
    return {
        f"{prefix}_seconds": round(seconds, 2),
        f"{prefix}_samples_per_second": round(rows / safe, 1),
        f"{prefix}_steps_per_second": round(steps / safe, 1),
        f"{prefix}_rows": float(rows),
    }


def merged(*parts: dict) -> dict:
    """One flat map; a name that occurs twice is an error."""
    result: dict = {}
    for part in parts:
        twice = result.keys() & part.keys()
        if twice:
            raise ValueError(f"named twice: {', '.join(sorted(twice))}")
        result.update(part)
    return result


def run_row(spark: SparkSession, run_id: str, params: dict, metrics: dict) -> DataFrame:
    """One run as a row of the runs table."""
    texts = {name: str(value) for name, value in params.items()}
    numbers = {name: float(value) for name, value in metrics.items()}
    return spark.createDataFrame([(run_id, texts, numbers)], RUNS)


def append_run(run: DataFrame, path: str) -> None:
    """Add a run to the runs table; an older row of the same run is replaced. Each run has a folder of its own."""
    run_id = run.select("run_id").first()[0]
    run.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={quote(run_id, safe='-_.')}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(f"{path.rstrip('/')}/run=*")


#: Endings of the names of metrics that tell of time or storage; they differ from run to run.
MEASURED = ("_seconds", "_minutes", "_per_second", "_size_mb")


def run_metrics(runs: DataFrame, measured: bool | None = None) -> DataFrame:
    """(run_id, metric, value) rows of the runs table.

    ``measured``: only metrics that tell of time or storage, only the others, or (None) all.
    """
    rows = runs.select("run_id", F.explode("metrics").alias("metric", "value"))
    if measured is None:
        return rows
    ends = F.lit(False)
    for ending in MEASURED:
        ends = ends | F.col("metric").endswith(ending)
    return rows.where(ends if measured else ~ends)


def best_checkpoint(log: DataFrame) -> DataFrame:
    """(run_id, best_epoch, f1): the epoch with the greatest f1, the earliest one on ties."""
    f1 = log.where((F.col("kind") == EVAL) & (F.col("metric") == "f1"))
    best = F.max(F.struct("value", (-F.col("epoch")).alias("_neg"))).alias("_best")
    return f1.groupBy("run_id").agg(best).select(
        "run_id", (-F.col("_best._neg")).alias("best_epoch"), F.col("_best.value").alias("f1")
    )


def best_epoch_metrics(log: DataFrame, digits: int = SCORE_DIGITS) -> DataFrame:
    """(run_id, metric, value) of each run's best epoch, its loss entry and its evaluation merged.

    Evaluation values are rounded and its runtime measures dropped; the epoch, to one digit, is told
    as ``best_model_epoch``. A best epoch without exactly one entry of each kind fails the job.
    """
    epoch = F.round("epoch", 1).alias("epoch")
    cells = log.groupBy("run_id", epoch, "kind", "metric").agg(
        F.max("value").alias("value"), F.count(F.lit(1)).alias("times")
    )

    def of_kind(kind: str):
        entry = F.struct("metric", "value", "times")
        return F.collect_list(F.when(F.col("kind") == kind, entry))

    # One group is the few distinct measures of an epoch.
    epochs = cells.groupBy("run_id", "epoch").agg(
        F.max(F.when((F.col("kind") == EVAL) & (F.col("metric") == "f1"), F.col("value"))).alias("f1"),
        of_kind(LOSS).alias("loss"),
        of_kind(EVAL).alias("eval"),
    )
    rank = F.struct("f1", (-F.col("epoch")).alias("_neg"))
    best = (
        epochs.where(F.col("f1").isNotNull())
        .groupBy("run_id")
        .agg(F.max_by(F.struct("epoch", "loss", "eval"), rank).alias("best"))
        .select("run_id", "best.*")
    )
    entries = F.concat("loss", "eval")
    broken = (F.size("loss") == 0) | (F.size("eval") == 0) | F.exists(entries, lambda e: e["times"] != 1)
    failure = F.raise_error(F.lit("the best epoch needs exactly one loss and one evaluation entry"))
    best = best.withColumn("epoch", F.when(broken, failure.cast("double")).otherwise(F.col("epoch")))

    def measure(metric, value):
        return F.struct(metric.alias("metric"), value.alias("value"))

    evaluated = F.transform(
        F.filter("eval", lambda e: ~e["metric"].isin(DROPPED_EVAL_METRICS)),
        lambda e: measure(e["metric"], F.round(e["value"], digits)),
    )
    best = best.withColumn("eval", evaluated)
    logged = F.transform(
        F.filter("loss", lambda e: ~F.exists("eval", lambda o: o["metric"] == e["metric"])),
        lambda e: measure(e["metric"], e["value"]),
    )
    told = F.array(measure(F.lit("best_model_epoch"), F.col("epoch")))
    return best.select("run_id", F.inline(F.concat(logged, "eval", told)))


def early_stop_epoch(
    log: DataFrame, threshold: float = EARLY_STOP_THRESHOLD, patience: int = EARLY_STOP_PATIENCE
) -> DataFrame:
    """(run_id, stop_epoch): the first epoch that ends ``patience`` epochs in a row without a gain in f1
    of more than ``threshold`` over the best earlier epoch; null if the run never stops early."""
    f1 = log.where((F.col("kind") == EVAL) & (F.col("metric") == "f1"))
    # One row per epoch, however often it was logged, so a window holds the few epochs of one run.
    f1 = f1.groupBy("run_id", "epoch").agg(F.max("value").alias("value"))
    in_run = Window.partitionBy("run_id").orderBy("epoch")
    best_before = F.max("value").over(in_run.rowsBetween(Window.unboundedPreceding, -1))
    gained = best_before.isNull() | (F.col("value") - best_before > threshold)
    steps = f1.withColumn("_gained", gained)
    steps = steps.withColumn("_streak", F.sum(F.col("_gained").cast("int")).over(in_run))
    in_streak = Window.partitionBy("run_id", "_streak").orderBy("epoch")
    # The first row of a streak is the gain itself.
    steps = steps.withColumn("_waited", F.row_number().over(in_streak) - 1)
    return steps.groupBy("run_id").agg(F.min(F.when(F.col("_waited") >= patience, F.col("epoch"))).alias("stop_epoch"))


def best_run(runs: DataFrame, by: str = "dataset", run: str = "run_id", f1: str = "f1") -> DataFrame:
    """The run with the greatest f1 per dataset, the first by name on ties."""
    best = F.min(F.struct((-F.col(f1)).alias("_neg"), F.col(run).alias("_run"))).alias("_best")
    return runs.where(F.col(f1).isNotNull()).groupBy(by).agg(best).select(
        by, F.col("_best._run").alias(run), (-F.col("_best._neg")).alias(f1)
    )
