"""Text to token ids and back, padding and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexiloom.config import BROADCAST_BYTES, END_ID, MAX_LENGTH, MEGA_BATCHES, PAD_ID, SEED, START_ID, UNKNOWN_ID
from lexiloom.functions.text import tokens
from lexiloom.functions.vectors import bind
from lexiloom.operators.lookup import find, hash_buckets, lookup_join, positions_of, with_value
from lexiloom.operators.ordering import dense_index
from lexiloom.operators.staging import fits, free_name, settle, with_stable_key
from lexiloom.operators.vocabulary import words

_MASK = "attention_mask"


def _kept_tokens(text: str, max_length: int | None) -> Column:
    found = tokens(text)
    if max_length is None:
        return found
    if max_length < 2:
        raise ValueError("max_length must leave room for the start and end ids")
    return F.slice(found, 1, max_length - 2)


def _framed(ids: Column) -> Column:
    return F.concat(F.array(F.lit(START_ID)), ids, F.array(F.lit(END_ID)))


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    text: str = "text",
    key: str | None = None,
    max_length: int | None = MAX_LENGTH,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``input_ids``: start, the ids of the tokens in order (1 for unknown ones), end.

    ``max_length`` counts the start and end ids; None keeps everything. A vocabulary measured
    within ``limit`` is handed to the tasks and every text is encoded in place, with no shuffle. For a
    larger one the tokens are joined to it and put together again by ``key``, which must be unique; without one the
    rows are settled with a key of their own.
    """
    known = words(vocabulary)
    buckets = hash_buckets(known, "token", "id", limit)
    if buckets:
        packed, n = buckets
        ready = with_value(df, "_buckets", packed)
        ids = F.transform(
            _kept_tokens(text, max_length), lambda t: F.coalesce(find(F.col("_buckets"), t, n), F.lit(UNKNOWN_ID))
        )
        return ready.select(*df.columns, _framed(ids).alias("input_ids"))
    columns = df.columns
    if key is None:
        key = free_name(df, "_row_key")
        df = with_stable_key(df, key)
    pieces = positions_of(df, key, _kept_tokens(text, max_length)).withColumnRenamed("item", "token")
    found = lookup_join(pieces, known, "token", "left", limit)
    # One group is one text, cut to max_length before it was taken apart.
    entry = F.struct("pos", F.coalesce("id", F.lit(UNKNOWN_ID)).alias("id"))
    lists = found.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    joined = df.join(lists, key, "left")
    ids = F.coalesce(F.col("_entries.id"), F.array().cast("array<int>"))
    return joined.select(*columns, F.when(F.col(text).isNotNull(), _framed(ids)).alias("input_ids"))


def decode(
    df: DataFrame, vocabulary: DataFrame, ids: str = "input_ids", key: str | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``tokens``: the token of each id, in order; null for an id outside the vocabulary.

    Tokens are found by the value of the id, which may have gaps. ``key`` and ``limit`` are as in :func:`encode`.
    """
    table = vocabulary.select(F.col("id").cast("int").alias("id"), "token")
    buckets = hash_buckets(table, "id", "token", limit)
    if buckets:
        packed, n = buckets
        ready = with_value(df, "_tokens", packed)
        named = F.transform(ids, lambda i: find(F.col("_tokens"), i.cast("int"), n))
        return ready.select(*df.columns, named.alias("tokens"))
    columns = df.columns
    if key is None:
        key = free_name(df, "_row_key")
        df = with_stable_key(df, key)
    pieces = positions_of(df, key, ids).withColumnRenamed("item", "id")
    found = lookup_join(pieces, table, "id", "left", limit)
    lists = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("_entries"))
    filled = F.coalesce("_entries.token", F.when(F.col(ids).isNotNull(), F.array().cast("array<string>")))
    return df.join(lists, key, "left").select(*columns, filled.alias("tokens"))


def padded(ids: str | Column, length: int | Column) -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    length = F.lit(length) if isinstance(length, int) else length
    return F.concat(ids, F.array_repeat(F.lit(PAD_ID), F.greatest(length - F.size(ids), F.lit(0))))


def mask(ids: str | Column, length: int | Column) -> Column:
    """1 for each id, 0 for each padding position after them."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    length = F.lit(length) if isinstance(length, int) else length
    gap = F.greatest(length - F.size(ids), F.lit(0))
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), gap))


def _pad_to(df: DataFrame, ids: str, length: int | Column) -> DataFrame:
    rest = [c for c in df.columns if c not in (ids, _MASK)]
    return df.select(*rest, padded(ids, length).alias(ids), mask(ids, length).alias(_MASK))


def pad_fixed(df: DataFrame, max_length: int = MAX_LENGTH, ids: str = "input_ids") -> DataFrame:
    """Pad every row to ``max_length`` and add its attention mask."""
    return _pad_to(df, ids, max_length)


def attention_mask(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Add the mask of rows that are not padded yet."""
    return df.withColumn(_MASK, mask(ids, F.size(ids)))


def assign_batches(df: DataFrame, order: list[str], batch_size: int) -> DataFrame:
    """Batches of ``batch_size`` rows in ``order``, which must end in a unique key.

    Batch the texts before encoding them: the numbering reads its input twice and moves it once.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    return dense_index(df, order, "idx").withColumn("batch", F.floor(F.col("idx") / F.lit(batch_size)).cast("long"))


def group_by_length(df: DataFrame, batch_size: int, length: str, key: str) -> DataFrame:
    """Batches of rows of similar length."""
    return assign_batches(df, [length, key], batch_size)


def _random_order(key: str | Column, seed: int) -> Column:
    """A value by which rows are in random order, the same one whenever it is computed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def group_by_length_shuffled(
    df: DataFrame, batch_size: int, length: str, key: str, seed: int = SEED, mega: int = MEGA_BATCHES
) -> DataFrame:
    """Batches of rows of similar length in random order: (..., idx, batch), idx being the place in the whole order.

    Rows are put in random order and cut into stretches of ``mega`` batches; inside a stretch the longest come first, and
    each run of ``batch_size`` is a batch. Then the batches are put in random order. A seed always gives the same batches.
    ``key`` must be unique. Pass narrow rows: they move twice, in stretches that no task sees more than a few of.
    """
    if batch_size < 1 or mega < 1:
        raise ValueError("batch_size and mega must be positive")
    columns = [name for name in df.columns if name not in ("idx", "batch")]
    placed = dense_index(df.select(*columns, _random_order(key, seed).alias("_order")), ["_order", key], "_spot")
    rows = placed.withColumn("_mega", F.floor(F.col("_spot") / F.lit(batch_size * mega)).cast("long"))
    # A stretch has batch_size * mega rows.
    inside = Window.partitionBy("_mega").orderBy(F.desc(length), "_order", key)
    rows = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    rows = rows.withColumn("_batch", F.col("_mega") * mega + F.floor(F.col("_rank") / F.lit(batch_size)).cast("long"))
    rows = rows.withColumn("_at", F.col("_rank") % F.lit(batch_size))
    rows = settle(rows.select(*columns, "_batch", "_at"))
    sizes = rows.groupBy("_batch").agg(F.count(F.lit(1)).alias("_rows"))
    numbered = dense_index(sizes.withColumn("_order", _random_order("_batch", seed)), ["_order", "_batch"], "batch")
    # Only the last stretch can have a batch that is not full; batches after it begin by that much earlier.
    short = numbered.where(F.col("_rows") < batch_size).agg(
        F.min("batch").alias("at"), F.coalesce(F.min(F.lit(batch_size) - F.col("_rows")), F.lit(0)).alias("gap")
    )
    starts = with_value(numbered, "_short", short.select(F.struct("at", "gap"))).select(
        "_batch", "batch",
        bind(F.col("_short"), lambda s: F.col("batch") * batch_size - F.when(F.col("batch") > s["at"], s["gap"]).otherwise(0)).alias("_start"),
    )
    return lookup_join(rows, starts, "_batch", "inner").select(*columns, (F.col("_start") + F.col("_at")).alias("idx"), "batch")


def pad_to_longest(df: DataFrame, ids: str = "input_ids", batch: str = "batch") -> DataFrame:
    """Pad the rows of each batch to the longest of them."""
    widest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    return _pad_to(df.withColumn("_width", widest), ids, F.col("_width")).drop("_width")


def batch_widths(df: DataFrame, order: list[str], batch_size: int, length: str) -> DataFrame:
    """Batches in ``order`` and, as ``width``, the greatest length of each: the plan of a padding, from narrow rows."""
    batched = assign_batches(df, order, batch_size)
    widths = batched.groupBy("batch").agg(F.max(length).alias("width"))
    return lookup_join(batched, widths, "batch", "inner").drop("idx")


def pad_in_batches(df: DataFrame, plan: DataFrame, key: str, ids: str = "input_ids", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Pad encoded rows by a plan (key, batch, width) of :func:`batch_widths`.

    Rows stay where they are if the plan was measured within ``limit``; a larger one is joined by ``key``.
    """
    plan = plan.select(key, "batch", F.col("width").alias("_width"))
    joined = df.join(F.broadcast(plan) if fits(plan, limit) else plan, key)
    return _pad_to(joined, ids, F.col("_width")).drop("_width")


def batches_cost(batched: DataFrame, strategy: str, length: str = "encoded_length") -> DataFrame:
    """(strategy, real, padded) positions of given batches."""
    batches = batched.groupBy("batch").agg(F.sum(length).alias("_real"), (F.max(length) * F.count(F.lit(1))).alias("_padded"))
    totals = batches.agg(F.coalesce(F.sum("_real"), F.lit(0)).alias("real"), F.coalesce(F.sum("_padded"), F.lit(0)).alias("padded"))
    return totals.select(F.lit(strategy).alias("strategy"), "real", "padded")


def padding_cost(
    df: DataFrame, batch_size: int, key: str, length: str = "encoded_length", max_length: int = MAX_LENGTH
) -> DataFrame:
    """Real and padded positions under fixed, dynamic and length-grouped padding.

    Needs the encoded lengths only, not the ids, and reads the texts once. Fixed and length-grouped padding follow from
    the number of rows of each length; only dynamic padding numbers rows.
    """
    lengths = settle(df.select(key, F.col(length).cast("long").alias("n")))
    # One row per distinct length, of which there are at most ``max_length``.
    histogram = lengths.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    end = F.sum("c").over(Window.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    size = F.lit(batch_size).cast("long")
    # A batch is as long as its last row; the batches that end among the rows of a length have that length.
    last = F.floor(F.col("end") / size) - F.floor((F.col("end") - F.col("c")) / size)
    real = F.sum(F.col("n") * F.col("c")).alias("real")
    both = histogram.withColumn("end", end).agg(
        real,
        (F.sum("c") * F.lit(max_length)).alias("fixed"),
        (F.sum(F.col("n") * size * last) + F.coalesce(F.max("n"), F.lit(0)) * (F.max("end") % size)).alias("by_length"),
    )
    batches = (
        assign_batches(lengths, [key], batch_size)
        .groupBy("batch")
        .agg(F.sum("n").alias("_real"), (F.max("n") * F.count(F.lit(1))).alias("_padded"))
    )
    dynamic = batches.agg(F.sum("_real").alias("real"), F.sum("_padded").alias("padded"))
    costs = both.select("real", F.inline(F.array(*[
        F.struct(F.lit(name).alias("strategy"), F.col(name).alias("padded")) for name in ("fixed", "by_length")
    ])))
    return costs.unionByName(dynamic.select(F.lit("dynamic").alias("strategy"), "real", "padded")).select(
        "strategy", "real", "padded"
    )
