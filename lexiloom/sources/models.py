"""Model tables: the weights of many runs in one place, selected by run id."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexiloom.operators.quantized import QuantizedModel
from lexiloom.operators.runs import stored_files
from lexiloom.operators.train import BIAS_ID, Model


def model_path(path: str, run_id: str) -> str:
    """Folder of a run's weights; the id is escaped, so any text names a folder of its own."""
    return f"{path.rstrip('/')}/run_id={quote(run_id, safe='-_.')}"


def save_model(model: Model, run_id: str, path: str) -> None:
    """Write a run's weights; an older table of the same run is replaced, other runs are left alone."""
    model.weights.write.mode("overwrite").parquet(model_path(path, run_id))


def load_model(spark: SparkSession, path: str, run_id: str, problem_type: str) -> Model:
    try:
        weights = spark.read.parquet(model_path(path, run_id)).select("id", "token", "weights")
    except AnalysisException as error:
        raise ValueError(f"run {run_id!r} has no model at {path}") from error
    bias = weights.where(F.col("id") == BIAS_ID).select(F.size("weights")).first()
    return Model(weights, bias[0], problem_type)


def save_quantized(model: QuantizedModel, run_id: str, path: str) -> None:
    """Write a quantized model: its steps and, beside them, one row that scales them."""
    folder = model_path(path, run_id)
    model.steps.write.mode("overwrite").parquet(f"{folder}/steps")
    model.scales.write.mode("overwrite").parquet(f"{folder}/scales")


def load_quantized(spark: SparkSession, path: str, run_id: str, problem_type: str) -> QuantizedModel:
    folder = model_path(path, run_id)
    try:
        steps = spark.read.parquet(f"{folder}/steps").select("id", "token", "steps")
        scales = spark.read.parquet(f"{folder}/scales").select("scales", "bias")
    except AnalysisException as error:
        raise ValueError(f"run {run_id!r} has no quantized model at {path}") from error
    return QuantizedModel(steps, scales, scales.select(F.size("scales")).first()[0], problem_type)


def model_sizes(spark: SparkSession, path: str, run_ids: list[str]) -> DataFrame:
    """(run_id, files, bytes, mb, share) of stored models, from listings of their files; share is of the first one's bytes."""
    sized = None
    for run_id in run_ids:
        one = stored_files(spark, model_path(path, run_id)).select(F.lit(run_id).alias("run_id"), "files", "bytes")
        sized = one if sized is None else sized.unionByName(one)
    first = sized.where(F.col("run_id") == run_ids[0]).select("bytes")
    return sized.withColumn("_first", first.scalar()).select(
        "run_id", "files", "bytes", F.round(F.col("bytes") / (1024 * 1024), 3).alias("mb"),
        F.round(F.col("bytes") / F.col("_first"), 3).alias("share"),
    )
