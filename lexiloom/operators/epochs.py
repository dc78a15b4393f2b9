"""Linear classifiers trained in epochs, evaluated after each, stopped early, best epoch kept; one or many at a time."""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from lexiloom.config import (
    BROADCAST_BYTES, EARLY_STOP_PATIENCE, EARLY_STOP_THRESHOLD, MAX_EPOCHS, MULTI_LABEL, START_ID, WEIGHT_DECAY,
)
from lexiloom.functions.text import tokens
from lexiloom.functions.vectors import activation
from lexiloom.operators.evaluate import METRICS, metrics_for
from lexiloom.operators.lookup import dense_array, find, hash_buckets, with_value
from lexiloom.operators.runs import EVAL, LOSS
from lexiloom.operators.staging import Scratch, measure, settle
from lexiloom.operators.train import BIAS_ID, Model
from lexiloom.operators.vocabulary import FIRST_ID, words
from lexiloom.schemas import METRIC_LOG

# Decay of the running means of gradients and of their squares, and the guard of the division.
MEAN_DECAY, SQUARE_DECAY, GUARD = 0.9, 0.999, 1e-8

#: Bytes that a row of the head takes besides its token or its values, bytes of one bucket and of a tail entry in it, about.
#: Sums per text and per id are taken within a bucket before they move, so few large ones move less.
HEAD_OVERHEAD, BUCKET_BYTES, ENTRY_BYTES = 64, 256 * 1024 * 1024, 16

#: As many of the first ids of the tail are matched by broadcast when it is looked up: a short head leaves frequent tokens to it.
HOT_IDS = 10_000


class Setting(NamedTuple):
    """How one model is trained."""

    learning_rate: float = 0.02
    weight_decay: float = WEIGHT_DECAY
    patience: int = EARLY_STOP_PATIENCE
    threshold: float = EARLY_STOP_THRESHOLD


class EpochRun(NamedTuple):
    """The model of the best epoch and the metric log of all of them."""

    model: Model
    log: DataFrame


class Examples(NamedTuple):
    """Encoded rows: (row, label, ids, tail array<struct<id, n>>) and, if there is a tail, its entries (id, row, n) by id.

    ``ids`` holds the start id, whose weight is the bias, and the tokens of the head, repeated as often as they occur.
    """

    rows: DataFrame
    tail: DataFrame | None
    buckets: int = 0


def _head_size(vocabulary: DataFrame, slots: int, limit: int) -> int | None:
    """Ids below it are looked up in place: they are ranks, so these are the most frequent tokens. None: all ids.

    Both the tokens and the weights of the head are within ``limit``.
    """
    rows, size = measure(vocabulary.select("id", "token"))
    # Weights of one token, and the longest of both kinds of rows decides.
    row = max(size / max(rows, 1), HEAD_OVERHEAD + 8 * slots)
    return None if rows * row <= limit else max(FIRST_ID, int(limit / row))


def _encoded(
    df: DataFrame, vocabulary: DataFrame, label: str, head: int | None, scratch: Scratch, buckets: int = 0, least: int = 1
) -> Examples:
    """Encode once. Only tokens outside the head are joined to the vocabulary; they are rare ones by their rank.

    All tables that meet must have equal numbers of ``buckets``; without one it follows the tail and is ``least`` at least.
    """
    known = words(vocabulary)
    near = known if head is None else known.where(F.col("id") < head)
    packed, n = hash_buckets(near, "token", "id", limit=1 << 62)
    ready = with_value(df.select(label, "text"), "_buckets", packed)
    found = F.transform(tokens("text"), lambda t: F.struct(t.alias("t"), find(F.col("_buckets"), t, n).alias("i")))
    rows = ready.select(label, F.coalesce(found, F.array().cast("array<struct<t:string,i:int>>")).alias("_found"))
    ids = F.filter(F.col("_found.i"), lambda i: i.isNotNull())
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), label, F.concat(F.array(F.lit(START_ID)), ids).alias("ids"),
        F.transform(F.filter("_found", lambda x: x["i"].isNull()), lambda x: x["t"]).alias("_rest"),
    )
    rows = scratch.keep(rows)
    none = F.array().cast("array<struct<id:int,n:bigint>>")
    if head is None:
        return Examples(rows.select("row", label, "ids", none.alias("tail")), None)
    if not buckets:
        size = (rows.agg(F.sum(F.size("_rest"))).first()[0] or 0) * ENTRY_BYTES
        spark = df.sparkSession
        # Sums come in as many partitions as a shuffle of the session has. Were buckets fewer, tables would move to meet them.
        shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(spark.sparkContext.defaultParallelism, shuffled, least, -(-size // BUCKET_BYTES))
    pieces = rows.select("row", F.explode("_rest").alias("token"))
    hot = F.broadcast(known.where(F.col("id").between(head, head + HOT_IDS - 1)))
    cold = pieces.join(hot.select("token"), "token", "left_anti").join(known.where(F.col("id") >= head + HOT_IDS), "token")
    entries = pieces.join(hot, "token").unionByName(cold).select("id", "row")
    # Rows of an id are in one task, so its texts are counted where they lie.
    dealt = entries.repartition(buckets, "id").groupBy("id", "row").agg(F.count(F.lit(1)).alias("n"))
    tail = scratch.keep(dealt, "id", buckets, placed=True)
    # One group is the tail of one text.
    lists = tail.repartition(buckets, "row").groupBy("row").agg(F.collect_list(F.struct("id", "n")).alias("tail"))
    lists = scratch.keep(lists, "row", buckets, placed=True)
    near = scratch.keep(rows.select("row", label, "ids"), "row", buckets)
    scratch.drop(rows)
    together = near.join(lists, "row", "left").select("row", label, "ids", F.coalesce("tail", none).alias("tail"))
    return Examples(together, tail, buckets)


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def _scored(examples: Examples, state: DataFrame, slots: int, head: int | None) -> DataFrame:
    """``rows`` with ``logits`` of all models side by side.

    Weights of the head are handed to the tasks. Entries of the tail meet theirs where both lie, in buckets of ids; only
    their sums per text and bucket move.
    """
    near = state if head is None else state.where(F.col("id") < head)
    table = with_value(examples.rows, "_weights", dense_array(near, "id", "w"))

    def add(acc: Column, i: Column) -> Column:
        return F.zip_with(acc, F.get(F.col("_weights"), i), lambda a, w: a + w)

    scored = table.select(*examples.rows.columns, F.aggregate("ids", _zeros(slots), add).alias("logits"))
    if examples.tail is None:
        return scored
    found = examples.tail.join(state.select("id", "w"), "id")
    sums = [F.sum(F.col("n") * F.get("w", F.lit(k))) for k in range(slots)]
    per_row = found.groupBy("row").agg(F.array(*sums).alias("_far"))
    both = F.coalesce(F.zip_with("logits", "_far", lambda a, b: a + b), F.col("logits"))
    return scored.join(per_row, "row", "left").select(*examples.rows.columns, both.alias("logits"))


def _model(values: str | Column, number: int, outputs: int) -> Column:
    """The part of one model in values side by side."""
    return F.slice(values, number * outputs + 1, outputs)


def _gradients(scored: DataFrame, label: str, outputs: int, models: int, problem_type: str) -> DataFrame:
    """(id, g, loss): sums of residuals per token; losses, one per model, are on the start id, which every text has once.

    Residuals are summed on the map side, so the shuffle carries the vocabulary, not the texts.
    """
    if problem_type == MULTI_LABEL:
        truth = F.transform(label, lambda y: y.cast("double"))
    else:
        truth = F.transform(
            F.sequence(F.lit(0), F.lit(outputs - 1)), lambda k: F.when(k == F.col(label), 1.0).otherwise(0.0)
        )

    def cost(p: Column, y: Column) -> Column:
        wrong = (1.0 - y) * F.log(F.greatest(1.0 - p, F.lit(1e-12))) if problem_type == MULTI_LABEL else F.lit(0.0)
        return -(y * F.log(F.greatest(p, F.lit(1e-12))) + wrong)

    def total(p: Column) -> Column:
        return F.aggregate(F.zip_with(p, "_y", cost), F.lit(0.0), lambda acc, x: acc + x)

    shares = [activation(_model("logits", i, outputs), problem_type=problem_type).alias(f"_p{i}") for i in range(models)]
    rows = scored.select("ids", "tail", truth.alias("_y"), *shares)
    residuals = [F.zip_with(f"_p{i}", "_y", lambda p, y: p - y) for i in range(models)]
    rows = rows.select(
        F.concat(F.transform("ids", lambda i: F.struct(i.alias("id"), F.lit(1).cast("bigint").alias("n"))), "tail").alias("_all"),
        F.concat(*residuals).alias("_r"), F.array(*[total(F.col(f"_p{i}")) for i in range(models)]).alias("_loss"),
    )
    entries = rows.select(F.explode_outer("_all").alias("_e"), "_r", "_loss").select("_e.id", "_e.n", "_r", "_loss")
    sums = [F.sum(F.col("n") * F.get("_r", F.lit(k))) for k in range(outputs * models)]
    losses = [F.sum(F.when(F.col("id") == START_ID, F.get("_loss", F.lit(i)))) for i in range(models)]
    return entries.groupBy("id").agg(F.array(*sums).alias("g"), F.array(*losses).alias("loss"))


def _step(state: DataFrame, gradients: DataFrame, rows: int, epoch: int, settings: list[Setting | None], outputs: int, max_epochs: int) -> DataFrame:
    """Move the weights against the gradient, scaled by its running size, and shrink them a little.

    A model that has stopped (None) keeps its values.
    """
    slots = outputs * len(settings)
    rates, shrinks = [], []
    for setting in settings:
        rate = _rate(setting, epoch, max_epochs) if setting else 0.0
        rates += [rate] * outputs
        shrinks += [1.0 - rate * setting.weight_decay if setting else 1.0] * outputs
    numbers = lambda values: F.array(*[F.lit(x) for x in values])
    g = F.coalesce(F.transform("g", lambda x: x / F.lit(float(rows))), _zeros(slots))
    joined = state.join(gradients, "id", "left").select("id", "w", "m", "v", "loss", g.alias("g"))
    on = numbers([float(setting is not None) for setting in settings for _ in range(outputs)])
    mean = F.zip_with("m", "g", lambda m, x: m * MEAN_DECAY + x * (1 - MEAN_DECAY))
    square = F.zip_with("v", "g", lambda v, x: v * SQUARE_DECAY + x * x * (1 - SQUARE_DECAY))
    moved = joined.select("id", "w", "loss", mean.alias("m"), square.alias("v"))
    move = F.zip_with(
        "m", "v", lambda m, v: (m / (1 - MEAN_DECAY**epoch)) / (F.sqrt(v / (1 - SQUARE_DECAY**epoch)) + F.lit(GUARD))
    )
    if any(setting is None for setting in settings):
        move = F.zip_with(move, on, lambda d, o: d * o)
    shrunk = F.zip_with("w", numbers(shrinks), lambda w, s: w * s)
    after = F.zip_with(shrunk, F.zip_with(move, numbers(rates), lambda d, r: d * r), lambda w, d: w - d)
    return moved.select("id", after.alias("w"), "m", "v", "loss")


def _rate(setting: Setting, epoch: int, max_epochs: int) -> float:
    return setting.learning_rate * (1 - (epoch - 1) / max_epochs)


def train_epoch_grid(
    train: DataFrame,
    evaluation: DataFrame,
    vocabulary: DataFrame,
    outputs: int,
    problem_type: str,
    settings: dict[str, Setting],
    max_epochs: int = MAX_EPOCHS,
    limit: int = BROADCAST_BYTES,
) -> dict[str, EpochRun]:
    """Fit a fresh model for each setting (by run id) by gradient steps over all of train, one step per epoch, at a falling rate.

    All models share the encoded texts and the passes over them: an epoch is one pass over train and one over the
    evaluation rows for all models that still run, whose weights lie side by side. Each stops by itself, when its f1 has
    not grown by more than its threshold for as many epochs as its patience. Only losses, metrics and these decisions
    come to the driver. The state of each epoch is written, so the plan does not grow and a lost executor costs one epoch
    at most; states that no model needs are deleted.

    Ids are ranks by frequency. The head, as many of the most frequent tokens as are within ``limit``, is looked up in
    place; the tail is kept once by id and once by text, in buckets, so no token moves after the first epoch.
    """
    if not settings:
        raise ValueError("no settings")
    spark = train.sparkSession
    label = "labels" if problem_type == MULTI_LABEL else "label"
    names, running = list(settings), dict(settings)
    slots = outputs * len(names)
    scratch = Scratch(spark)
    head = _head_size(vocabulary, slots, limit)
    least = 1 if head is None else -(-vocabulary.count() * 24 * slots // BUCKET_BYTES)
    train_rows = _encoded(train, vocabulary, label, head, scratch, least=least)
    buckets = train_rows.buckets
    evaluation_rows = _encoded(evaluation, vocabulary, label, head, scratch, buckets)
    # Gradients go to the buckets of the state that they move, so later states are in their places already.
    keep = lambda df, placed: scratch.keep(df, "id" if buckets else None, buckets, placed)
    blank = _zeros(slots)
    state = keep(vocabulary.select("id", blank.alias("w"), blank.alias("m"), blank.alias("v")), placed=False)
    rows = train_rows.rows.count()
    entries: list[tuple] = []
    best = {name: (state, None) for name in names}
    waited = dict.fromkeys(names, 0)
    for epoch in range(1, max_epochs + 1):
        now = [running.get(name) for name in names]
        gradients = _gradients(_scored(train_rows, state, slots, head), label, outputs, len(names), problem_type)
        before = state
        stepped = keep(_step(state.select("id", "w", "m", "v"), gradients, rows, epoch, now, outputs, max_epochs), placed=True)
        state = stepped
        losses = state.where(F.col("id") == START_ID).first()["loss"] or [0.0] * len(names)
        started = time.perf_counter()
        scored = _scored(evaluation_rows, state, slots, head)
        cut = [
            F.struct(F.lit(name).alias("run"), _model("logits", i, outputs).alias("logits"))
            for i, name in enumerate(names)
            if name in running
        ]
        per_model = metrics_for(scored.select(label, F.inline(F.array(*cut))), problem_type, by=("run",))
        measured = {row["run"]: row for row in per_model.collect()}
        seconds = time.perf_counter() - started
        for i, name in enumerate(names):
            if name not in running:
                continue
            setting, row = running[name], measured.get(name)
            found = {metric: row[metric] if row else 0.0 for metric in METRICS}
            logged = {
                LOSS: {"loss": (losses[i] or 0.0) / max(rows, 1), "learning_rate": _rate(setting, epoch, max_epochs), "step": epoch},
                EVAL: {**found, "eval_runtime": seconds, "step": epoch},
            }
            entries += [
                (name, float(epoch), kind, metric, float(value))
                for kind, values in logged.items()
                for metric, value in values.items()
            ]
            highest = best[name][1]
            waited[name] = 0 if highest is None or found["f1"] - highest > setting.threshold else waited[name] + 1
            if highest is None or found["f1"] > highest:
                best[name] = (state, found["f1"])
            if waited[name] >= setting.patience:
                del running[name]
        if all(before is not kept for kept, _ in best.values()):
            scratch.drop(before)
        if not running:
            break
    log = spark.createDataFrame(entries, METRIC_LOG)
    is_bias = F.col("id") == START_ID
    named = vocabulary.select("id", "token").where(is_bias | (F.col("id") >= FIRST_ID))
    runs = {}
    for i, name in enumerate(names):
        weights = best[name][0].select("id", _model("w", i, outputs).alias("weights")).join(named, "id").select(
            F.when(is_bias, BIAS_ID).otherwise(F.col("id")).alias("id"),
            F.when(~is_bias, F.col("token")).alias("token"),
            "weights",
        )
        runs[name] = EpochRun(Model(settle(weights), outputs, problem_type), log.where(F.col("run_id") == name))
    scratch.close()
    return runs


def train_epochs(
    train: DataFrame,
    evaluation: DataFrame,
    vocabulary: DataFrame,
    outputs: int,
    problem_type: str,
    run_id: str = "run",
    max_epochs: int = MAX_EPOCHS,
    learning_rate: float = 0.02,
    weight_decay: float = WEIGHT_DECAY,
    patience: int = EARLY_STOP_PATIENCE,
    threshold: float = EARLY_STOP_THRESHOLD,
    limit: int = BROADCAST_BYTES,
) -> EpochRun:
    """One model; see :func:`train_epoch_grid`."""
    settings = {run_id: Setting(learning_rate, weight_decay, patience, threshold)}
    return train_epoch_grid(train, evaluation, vocabulary, outputs, problem_type, settings, max_epochs, limit)[run_id]
