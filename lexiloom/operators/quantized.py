"""Models in 8-bit steps: made from full weights, scored in integers, compared with the full model."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from lexiloom.config import BROADCAST_BYTES, MULTI_LABEL
from lexiloom.functions.vectors import activation, bind, decisions, round_scores, top_index
from lexiloom.operators.evaluate import METRICS, micro_metrics
from lexiloom.operators.lookup import with_value
from lexiloom.operators.score import require_text, token_sums
from lexiloom.operators.staging import settle
from lexiloom.operators.train import BIAS_ID, Model

#: Steps go from -STEPS to STEPS.
STEPS = 127


class QuantizedModel(NamedTuple):
    """Token weights as steps and what turns sums of steps into scores.

    ``steps``: (id, token, steps array<tinyint>); ``scales``: one row (scales, bias), both array<double> with one value
    per output. The bias is added once per text and stays in full precision.
    """

    steps: DataFrame
    scales: DataFrame
    outputs: int
    problem_type: str


def quantize_model(model: Model) -> QuantizedModel:
    """Divide the weights of each output by a scale, the greatest of them by 127, and round, halves to even.

    The scales come from one aggregation over the weights; an output whose weights are all 0 has the scale 1.
    """
    tokens = model.weights.where(F.col("id") != BIAS_ID)
    peaks = tokens.agg(*[
        (F.coalesce(F.max(F.abs(F.get("weights", F.lit(k)))), F.lit(0.0))).alias(f"_{k}") for k in range(model.outputs)
    ])
    scale = lambda peak: F.when(peak > 0, peak / F.lit(float(STEPS))).otherwise(F.lit(1.0))
    bias = model.weights.where(F.col("id") == BIAS_ID).select("weights")
    scales = settle(
        with_value(peaks, "bias", bias).select(
            F.array(*[scale(F.col(f"_{k}")) for k in range(model.outputs)]).alias("scales"), "bias"
        )
    )
    steps = with_value(tokens, "_scales", scales.select("scales")).select(
        "id", "token",
        F.zip_with("weights", F.col("_scales"), lambda w, s: F.rint(w / s).cast("tinyint")).alias("steps"),
    )
    return QuantizedModel(settle(steps), scales, model.outputs, model.problem_type)


def dequantize_model(model: QuantizedModel) -> Model:
    """The weights that the steps stand for, as a full model."""
    tokens = with_value(model.steps, "_scales", model.scales.select("scales")).select(
        "id", "token", F.zip_with("steps", F.col("_scales"), lambda q, s: q.cast("double") * s).alias("weights")
    )
    bias = model.scales.select(
        F.lit(BIAS_ID).alias("id"), F.lit(None).cast("string").alias("token"), F.col("bias").alias("weights")
    )
    return Model(settle(tokens.unionByName(bias)), model.outputs, model.problem_type)


def _scaled(sums: Column, scales: Column) -> Column:
    """Logits from whole-numbered sums: each is scaled once."""
    products = F.zip_with(sums, scales["scales"], lambda n, s: n * s)
    return F.zip_with(scales["bias"], products, lambda b, x: b + x)


def add_quantized_logits(
    df: DataFrame, model: QuantizedModel, text: str = "text", key: str | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``logits`` like :func:`lexiloom.operators.score.add_logits`: the steps of all tokens are added as integers,
    so the sum does not depend on their order, and are scaled once."""
    require_text(df, text)
    sums = token_sums(df, model.steps, {"steps": "bigint"}, model.outputs, text, key, limit)
    ready = with_value(sums, "_scales", model.scales.select(F.struct("scales", "bias")))
    logits = bind(F.col("_scales"), lambda s: _scaled(F.col("_steps"), s))
    return ready.select(*df.columns, F.when(F.col(text).isNotNull(), logits).alias("logits"))


def batch_score_quantized(
    df: DataFrame, model: QuantizedModel, text: str = "text", key: str | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``probabilities`` of the quantized model, rounded."""
    scored = add_quantized_logits(df, model, text, key, limit)
    return scored.select(
        *df.columns, round_scores(activation("logits", problem_type=model.problem_type)).alias("probabilities")
    )


def add_both_logits(
    df: DataFrame, model: Model, quantized: QuantizedModel, text: str = "text", key: str | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``logits`` and ``quantized_logits``: one pass over the texts looks each token up once, for both models."""
    require_text(df, text)
    weights = model.weights.where(F.col("id") != BIAS_ID).select("id", "token", "weights")
    both = weights.join(quantized.steps.select("token", "steps"), "token")
    sums = token_sums(df, both, {"weights": "double", "steps": "bigint"}, model.outputs, text, key, limit)
    bias = model.weights.where(F.col("id") == BIAS_ID).select("weights")
    ready = with_value(sums, "_bias", bias)
    ready = with_value(ready, "_scales", quantized.scales.select(F.struct("scales", "bias")))
    full = F.zip_with(F.col("_bias"), "_weights", lambda b, x: b + x)
    scaled = bind(F.col("_scales"), lambda s: _scaled(F.col("_steps"), s))
    known = F.col(text).isNotNull()
    return ready.select(
        *df.columns, F.when(known, full).alias("logits"), F.when(known, scaled).alias("quantized_logits")
    )


def compare_with_quantized(
    df: DataFrame, model: Model, quantized: QuantizedModel, text: str = "text", key: str | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(model, f1, precision, recall, same, n_rows) of both models on labelled rows, from one pass and one aggregation.

    ``same`` counts the rows on which both choose the same label, or for multi-label problems the same set of them.
    """
    scored = add_both_logits(df, model, quantized, text, key, limit)
    names = {"full": "logits", "quantized": "quantized_logits"}
    if model.problem_type == MULTI_LABEL:
        chosen = {name: decisions(column) for name, column in names.items()}
        rows = scored.select("labels", *[value.alias(name) for name, value in chosen.items()])

        def cells(name: str, p: float, y: float) -> Column:
            pairs = F.zip_with(name, "labels", lambda a, b: (a == p) & (b == y))
            return F.coalesce(F.sum(F.size(F.filter(pairs, lambda x: x))), F.lit(0))

        parts = [
            value.alias(f"{name}_{part}")
            for name in names
            for part, value in (("tp", cells(name, 1.0, 1.0)), ("fp", cells(name, 1.0, 0.0)), ("fn", cells(name, 0.0, 1.0)))
        ]
    else:
        rows = scored.select("label", *[top_index(column).alias(name) for name, column in names.items()])
        parts = []
        for name in names:
            hits = F.count(F.when(F.col(name) == F.col("label"), 1))
            wrong = F.count(F.lit(1)) - hits
            parts += [hits.alias(f"{name}_tp"), wrong.alias(f"{name}_fp"), wrong.alias(f"{name}_fn")]
    same = F.count(F.when(F.col("full") == F.col("quantized"), 1)).alias("same")
    totals = rows.agg(*parts, same, F.count(F.lit(1)).alias("n_rows"))
    per_model = totals.select(
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("model"), *[F.col(f"{name}_{part}").alias(part) for part in ("tp", "fp", "fn")], "same", "n_rows")
            for name in names
        ]))
    )
    return micro_metrics(per_model, ("model", "same", "n_rows")).select("model", *METRICS, "same", "n_rows")
