"""Batch scoring."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lexiloom.config import BROADCAST_BYTES, INFERENCE_BATCH
from lexiloom.functions.text import tokens
from lexiloom.functions.vectors import activation, bind, round_scores
from lexiloom.operators.lookup import find, hash_buckets, lookup_join, with_value
from lexiloom.operators.staging import fits, free_name, measure, with_stable_key
from lexiloom.operators.train import BIAS_ID, Model
from lexiloom.operators.vocabulary import FIRST_ID


#: A table summed in place is part of every task, and is read anew by it: above this it is broadcast once per executor instead.
IN_PLACE_BYTES = 8 * 1024 * 1024


def require_text(df: DataFrame, text: str) -> None:
    if text not in df.columns or not isinstance(df.schema[text].dataType, T.StringType):
        raise TypeError(f"scoring needs a string column {text!r}")


def _by_rank(table: DataFrame, values: list[str], limit: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the most frequent tokens, measured within ``limit``, and those of the others, None if all are within it.

    Ids are ranks, so the most frequent ones are the first.
    """
    rows, size = measure(table.select("token", *values))
    if size <= limit:
        return table.select("token", *values), None
    head = FIRST_ID + int(limit * rows / max(size, 1))
    while True:
        near = table.where(F.col("id") < head).select("token", *values)
        if head == FIRST_ID or fits(near, limit):
            return near, table.where(F.col("id") >= head).select("token", *values)
        head = FIRST_ID + (head - FIRST_ID) // 2


def _sums_by_parts(
    df: DataFrame, table: DataFrame, columns: dict[str, str], outputs: int, text: str, key: str | None, limit: int
) -> DataFrame:
    """:func:`token_sums` for a table (id, token, ...) too large to be part of every task.

    The most frequent tokens, which are nearly all occurrences, meet their values in a broadcast and are summed before
    they move; only the others, if the table is above ``limit``, are joined by shuffle. Tokens are rows here, not elements
    of arrays, as Spark compiles joins and sums of rows but interprets functions over arrays.
    """
    names = df.columns
    near, far = _by_rank(table, list(columns), limit)
    zeros = {name: F.array_repeat(F.lit(0).cast(kind), outputs) for name, kind in columns.items()}
    row = key or free_name(df, "_row_key")
    kept = df if key else with_stable_key(df, row)
    rows = kept.select(row, F.explode(tokens(text)).alias("token"))
    found = rows.join(F.broadcast(near), "token").select(row, *columns)
    if far is not None:
        rest = rows.join(F.broadcast(near.select("token")), "token", "left_anti")
        found = found.unionByName(lookup_join(rest, far, "token", "inner", limit).select(row, *columns))
    sums = {c: F.array(*[F.sum(F.get(c, F.lit(k)).cast(kind)) for k in range(outputs)]) for c, kind in columns.items()}
    per_row = found.groupBy(row).agg(*[value.alias(f"_{c}") for c, value in sums.items()])
    joined = kept.join(per_row, row, "left")
    return joined.select(*names, *[F.coalesce(f"_{c}", zeros[c]).alias(f"_{c}") for c in columns])


def token_sums(
    df: DataFrame, table: DataFrame, columns: dict[str, str], outputs: int, text: str = "text", key: str | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``_name`` for each array column of ``table`` (id, token, ...): its values summed over the tokens of the text.

    ``columns`` names the columns and the type to sum in. A table measured within ``limit`` and ``IN_PLACE_BYTES`` is handed
    to the tasks and rows are summed in place, with no shuffle and no key; each token is looked up once for all columns. Of a
    larger one the most frequent tokens, within ``limit``, are broadcast and others are joined by shuffle; sums are made by
    ``key``, which must be unique; without one the rows are settled with a key of their own.
    """
    zeros = {name: F.array_repeat(F.lit(0).cast(kind), outputs) for name, kind in columns.items()}
    entries = table.select("token", F.struct(*columns).alias("_v"))
    packed = hash_buckets(entries, "token", "_v", min(limit, IN_PLACE_BYTES))
    if packed:
        buckets, n = packed
        ready = with_value(df, "_buckets", buckets)

        def add(acc: Column, t: Column) -> Column:
            more = lambda v: F.struct(*[F.zip_with(acc[c], v[c], lambda a, w: a + w).alias(c) for c in columns])
            return bind(find(F.col("_buckets"), t, n), lambda v: F.when(v.isNull(), acc).otherwise(more(v)))

        start = F.struct(*[zero.alias(name) for name, zero in zeros.items()])
        summed = ready.select(*df.columns, F.aggregate(F.coalesce(tokens(text), F.array().cast("array<string>")), start, add).alias("_sums"))
        return summed.select(*df.columns, *[F.col("_sums")[name].alias(f"_{name}") for name in columns])
    return _sums_by_parts(df, table, columns, outputs, text, key, limit)


def add_logits(
    df: DataFrame, model: Model, text: str = "text", key: str | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``logits``: bias plus the weights of all tokens of the text; tokens the model lacks add nothing.

    A model measured within ``limit`` is handed to the tasks and rows are scored in place, with no
    shuffle and no key. Of a larger one the most frequent tokens are broadcast and others are joined by shuffle; sums are made
    by ``key``, which must be unique; without one the rows are settled with a key of their own. A null text has null logits.
    """
    require_text(df, text)
    weights = model.weights.where(F.col("id") != BIAS_ID).select("token", "weights")
    bias = model.weights.where(F.col("id") == BIAS_ID).select("weights")
    buckets = hash_buckets(weights, "token", "weights", limit)
    if buckets:
        packed, n = buckets
        ready = with_value(with_value(df, "_bias", bias), "_buckets", packed)
        logits = F.aggregate(
            tokens(text),
            F.col("_bias"),
            lambda acc, t: F.coalesce(F.zip_with(acc, find(F.col("_buckets"), t, n), lambda a, w: a + w), acc),
        )
        return ready.select(*df.columns, logits.alias("logits"))
    # Told beforehand, so that the texts need not move where the caller leaves them out.
    known = free_name(df, "_known")
    ranked = model.weights.where(F.col("id") != BIAS_ID)
    summed = _sums_by_parts(
        df.withColumn(known, F.col(text).isNotNull()), ranked, {"weights": "double"}, model.outputs, text, key, limit
    )
    logits = F.zip_with(F.col("_bias"), "_weights", lambda b, x: b + x)
    return with_value(summed, "_bias", bias).select(*df.columns, F.when(F.col(known), logits).alias("logits"))


def batch_score(
    df: DataFrame,
    model: Model,
    text: str = "text",
    key: str | None = None,
    function: str | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``probabilities``, one per label and rounded; positions are label indices."""
    scored = add_logits(df, model, text, key, limit)
    return scored.select(
        *df.columns, round_scores(activation("logits", function, model.problem_type)).alias("probabilities")
    )


def batch_score_with(
    df: DataFrame,
    load: Callable[[], Callable[[np.ndarray], np.ndarray]],
    outputs: int,
    text: str = "text",
    batch_size: int = INFERENCE_BATCH,
    function: str = "none",
) -> DataFrame:
    """Score with a model of the user's: ``load`` runs once per Python worker and returns a function
    from a batch of texts to a matrix with one row per text and one column per label."""
    require_text(df, text)

    def make() -> Callable:
        predict = load()

        def checked(batch: np.ndarray) -> np.ndarray:
            scores = np.asarray(predict(batch), dtype=np.float64)
            if scores.shape != (len(batch), outputs):
                raise ValueError(f"expected {(len(batch), outputs)} scores, got {scores.shape}")
            if np.isnan(scores).any():
                raise ValueError("NaN in scores")
            return scores

        return checked

    score = predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    raw = df.withColumn("_raw", score(F.col(text)))
    return raw.select(*df.columns, round_scores(activation("_raw", function)).alias("probabilities"))
