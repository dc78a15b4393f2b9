"""Probabilities to labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexiloom.config import BROADCAST_BYTES
from lexiloom.functions.vectors import indices_above, indices_of_ones, top_index, top_score
from lexiloom.operators.lookup import find, hash_buckets, lookup_join, positions_of, with_value
from lexiloom.operators.prepare import attach_label_name
from lexiloom.operators.staging import with_stable_key


def predicted_probability(df: DataFrame, scores: str = "probabilities") -> DataFrame:
    return df.withColumn("predicted_probability", top_score(scores))


def predicted_label_index(df: DataFrame, scores: str = "probabilities") -> DataFrame:
    return df.withColumn("predicted_label_indx", top_index(scores))


def predicted_label(
    df: DataFrame, labels: DataFrame, index: str = "predicted_label_indx", name: str = "predicted_label"
) -> DataFrame:
    """Name of a label index, predicted or true."""
    return attach_label_name(df, labels, index, name)


def threshold_indices(df: DataFrame, scores: str = "probabilities") -> DataFrame:
    return df.withColumn("predicted_label_indxs", indices_above(scores))


def true_indices(df: DataFrame, flags: str = "labels") -> DataFrame:
    return df.withColumn("label_indxs", indices_of_ones(flags))


def index_names(
    df: DataFrame, labels: DataFrame, indices: str, names: str, key: str | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Label names of a list of indices, in the same order; an index without a name fails the job.

    Names are found by the value of ``idx``, which may have gaps. Where the label table is too large to hand to
    tasks, rows are put together again by ``key``, or by a key of their own if none is named.
    """
    rest = [c for c in df.columns if c != names]
    missing = F.raise_error(F.lit("label index is not in the label table")).cast("string")
    buckets = hash_buckets(labels.select(F.col("idx").cast("int").alias("idx"), "label"), "idx", "label", limit)
    if buckets:
        packed, n = buckets
        ready = with_value(df.withColumnRenamed(names, "_old") if names in df.columns else df, "_names", packed)
        named = F.transform(indices, lambda i: F.coalesce(find(F.col("_names"), i.cast("int"), n), missing))
        return ready.select(*rest, named.alias(names))
    if key is None:
        key = "_row_key"
        df = with_stable_key(df, key)
    pieces = positions_of(df, key, indices).withColumnRenamed("item", "idx")
    found = lookup_join(pieces, labels.select("idx", F.col("label").alias("_name")), "idx", "left", limit)
    entry = F.struct("pos", F.coalesce("_name", missing).alias("_name"))
    lists = found.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    filled = F.coalesce(F.col("_entries._name"), F.when(F.col(indices).isNotNull(), F.array().cast("array<string>")))
    return df.join(lists, key, "left").select(*rest, filled.alias(names))
