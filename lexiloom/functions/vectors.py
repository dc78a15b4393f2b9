"""Expressions on score vectors: one array per row, position = label index."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexiloom.config import DECISION_THRESHOLD, MULTI_LABEL, SCORE_DIGITS, SINGLE_LABEL


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, like a local variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(logits: str | Column) -> Column:
    """Shares of exp(x); the greatest value is subtracted first so that large scores do not overflow."""

    def shares(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
        return bind(total, lambda t: F.transform(powers, lambda x: x / t))

    logits = _col(logits)
    powers = bind(F.array_max(logits), lambda m: F.transform(logits, lambda x: F.exp(x - m)))
    return F.when(F.size(logits) > 0, bind(powers, shares))


def sigmoid(logits: str | Column) -> Column:
    return F.transform(_col(logits), logistic)


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def activation(logits: str | Column, function: str | None = None, problem_type: str = SINGLE_LABEL) -> Column:
    """Apply softmax, sigmoid or none; if not named, the problem type decides."""
    if function is None:
        function = "sigmoid" if problem_type == MULTI_LABEL else "softmax"
    if function == "softmax":
        return softmax(logits)
    if function == "sigmoid":
        return sigmoid(logits)
    if function == "none":
        return _col(logits)
    raise ValueError(f"unknown activation {function!r}")


def round_scores(scores: str | Column, digits: int = SCORE_DIGITS) -> Column:
    return F.transform(_col(scores), lambda x: F.round(x, digits))


def reject_nan(scores: str | Column) -> Column:
    """Fail on NaN: Spark would order it above every number."""
    scores = _col(scores)
    broken = F.exists(scores, lambda x: F.isnan(x))
    return F.when(broken, F.raise_error(F.lit("NaN in scores")).cast("array<double>")).otherwise(scores)


def top_score(scores: str | Column) -> Column:
    return F.array_max(_col(scores))


def top_index(scores: str | Column) -> Column:
    """First position of the greatest score, null for an empty or null vector."""
    scores = _col(scores)
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def _positions(values: Column, keep) -> Column:
    marked = F.transform(values, lambda x, i: F.when(keep(x), i))
    return F.filter(marked, lambda i: i.isNotNull())


def indices_above(scores: str | Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """Positions with a score strictly greater than the threshold, in order."""
    return _positions(_col(scores), lambda x: x > threshold)


def indices_of_ones(flags: str | Column) -> Column:
    return _positions(_col(flags), lambda x: x == 1.0)


def decisions(logits: str | Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """1.0 where the unrounded probability is at least the threshold, else 0.0."""
    return F.transform(_col(logits), lambda x: F.when(logistic(x) >= threshold, 1.0).otherwise(0.0))


def quantize(vector: str | Column) -> Column:
    """Signed 8-bit steps of a vector with its own scale: struct(scale double, steps array<tinyint>)."""
    vector = _col(vector)
    peak = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    scale = F.when(peak > 0, peak / F.lit(127.0)).otherwise(F.lit(1.0))
    return bind(
        scale,
        lambda s: F.struct(
            s.alias("scale"),
            F.transform(vector, lambda x: F.rint(x.cast("double") / s).cast("tinyint")).alias("steps"),
        ),
    )


def dequantize(packed: str | Column) -> Column:
    packed = _col(packed)
    return F.transform(packed["steps"], lambda q: q.cast("double") * packed["scale"])
