"""Metrics, model comparison and 8-bit weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexiloom.config import MULTI_LABEL
from lexiloom.functions.vectors import decisions, dequantize, quantize, top_index

METRICS = ("f1", "precision", "recall")


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def micro_metrics(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """f1, precision and recall from pooled tp, fp and fn."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *by,
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
    )


def single_label_metrics(
    df: DataFrame, scores: str = "logits", label: str = "label", by: tuple[str, ...] = ()
) -> DataFrame:
    """Micro metrics of the first greatest raw score against the label.

    A wrong row is one false positive and one false negative, so all three equal the accuracy.
    """
    hit = F.when(top_index(scores) == F.col(label), 1).otherwise(0)
    return metrics_of_hits(df.select(*by, hit.alias("_hit")), by)


def metrics_of_hits(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    wrong = F.count(F.lit(1)) - F.sum("_hit")
    counts = df.groupBy(*by).agg(F.sum("_hit").alias("tp"), wrong.alias("fp"), wrong.alias("fn"))
    return micro_metrics(counts, by)


def multi_label_metrics(
    df: DataFrame, scores: str = "logits", labels: str = "labels", by: tuple[str, ...] = ()
) -> DataFrame:
    """Micro metrics over all (row, label) cells; a raw score counts as 1 if its sigmoid is at least 0.5."""
    cells = F.zip_with(decisions(scores), F.col(labels), lambda p, y: F.struct(p.alias("p"), y.alias("y")))

    def cell_count(p: float, y: float) -> Column:
        return F.sum(F.size(F.filter("_cells", lambda c: (c["p"] == p) & (c["y"] == y))))

    counts = (
        df.select(*by, cells.alias("_cells"))
        .groupBy(*by)
        .agg(
            cell_count(1.0, 1.0).alias("tp"),
            cell_count(1.0, 0.0).alias("fp"),
            cell_count(0.0, 1.0).alias("fn"),
        )
    )
    return micro_metrics(counts, by)


def metrics_for(df: DataFrame, problem_type: str, **kwargs) -> DataFrame:
    """The metrics that belong to a problem type."""
    return multi_label_metrics(df, **kwargs) if problem_type == MULTI_LABEL else single_label_metrics(df, **kwargs)


def metric_report(metrics: DataFrame, by: tuple[str, ...] = (), digits: int = 3) -> DataFrame:
    """Metrics as (metric, value) rows, rounded."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.round(m, digits).alias("value")) for m in METRICS]
    return metrics.select(*by, F.inline(F.array(*pairs)))


def compare_models(predictions: dict[str, DataFrame], scores: str = "probabilities", label: str = "label") -> DataFrame:
    """The same metrics for several prediction tables, one row per model."""
    together = None
    for name, df in predictions.items():
        part = df.select(F.lit(name).alias("model"), scores, label)
        together = part if together is None else together.unionByName(part)
    return single_label_metrics(together, scores, label, by=("model",))


def agreement(first: DataFrame, second: DataFrame, key: str, scores: str = "probabilities") -> DataFrame:
    """Rows scored by both models and rows on which they choose the same label."""
    a = first.select(key, top_index(scores).alias("_a"))
    b = second.select(key, top_index(scores).alias("_b"))
    same = F.count(F.when(F.col("_a") == F.col("_b"), 1))
    return a.join(b, key).agg(F.count(F.lit(1)).alias("n_rows"), same.alias("n_same"))


def quantize_int8(df: DataFrame, vector: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Vectors as signed 8-bit steps with one scale per vector."""
    packed = df.select(*keep, quantize(vector).alias("_q"))
    return packed.select(*keep, F.col("_q.scale").alias("scale"), F.col("_q.steps").alias("steps"))


def dequantize_int8(df: DataFrame, keep: tuple[str, ...] = (), name: str = "vector") -> DataFrame:
    return df.select(*keep, dequantize(F.struct("scale", "steps")).alias(name))


def size_compare(df: DataFrame, vector: str, digits: int = 1) -> DataFrame:
    """Megabytes of the vectors as 4-byte floats and as 8-bit steps with a 4-byte scale each."""
    values = F.coalesce(F.sum(F.size(vector).cast("long")), F.lit(0))
    mb = F.lit(1024.0 * 1024.0)
    return df.agg(
        F.round(values * 4 / mb, digits).alias("full_mb"),
        F.round((values + F.count(F.lit(1)) * 4) / mb, digits).alias("quantized_mb"),
    )
