"""Several models on the same training data, compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexiloom.config import MULTI_LABEL
from lexiloom.operators.evaluate import metrics_for
from lexiloom.operators.score import add_logits
from lexiloom.operators.train import Counts, Model, fit_grid


def split_grid(scored: DataFrame, outputs: int, smoothings: list[float]) -> DataFrame:
    """One row per text and smoothing from logits of all models side by side."""
    cuts = [
        F.struct(F.lit(s).alias("smoothing"), F.slice("logits", i * outputs + 1, outputs).alias("logits"))
        for i, s in enumerate(smoothings)
    ]
    return scored.select(*[c for c in scored.columns if c != "logits"], F.inline(F.array(*cuts)))


def grid_runs(counts: Counts, evaluation: DataFrame, smoothings: list[float], key: str | None = None) -> DataFrame:
    """(smoothing, f1, precision, recall): all models come from one set of counts and score in one pass."""
    label = "labels" if counts.problem_type == MULTI_LABEL else "label"
    models: Model = fit_grid(counts, smoothings)
    scored = add_logits(evaluation, models, key=key).select(label, "logits")
    rows = split_grid(scored, counts.outputs, smoothings)
    return metrics_for(rows, counts.problem_type, by=("smoothing",))
