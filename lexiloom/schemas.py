"""Schemas of the stored tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

SINGLE_LABEL_EXAMPLES = T.StructType([
    T.StructField("text", T.StringType(), False),
    T.StructField("label", T.LongType(), False),
])

MULTI_LABEL_EXAMPLES = T.StructType([
    T.StructField("text", T.StringType(), False),
    T.StructField("labels", T.ArrayType(T.FloatType()), False),
])

LABELS = T.StructType([
    T.StructField("idx", T.IntegerType(), False),
    T.StructField("label", T.StringType(), False),
])

NAMED_EXAMPLES = T.StructType([
    T.StructField("text", T.StringType(), False),
    T.StructField("label", T.LongType(), False),
    T.StructField("label_name", T.StringType(), False),
])

SINGLE_LABEL_PREDICTIONS = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("label_indx", T.IntegerType()),
    T.StructField("is_train", T.IntegerType()),
    T.StructField("probabilities", T.ArrayType(T.FloatType())),
    T.StructField("predicted_probability", T.FloatType()),
    T.StructField("predicted_label_indx", T.IntegerType()),
    T.StructField("predicted_label", T.StringType()),
    T.StructField("label", T.StringType()),
])

MULTI_LABEL_PREDICTIONS = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("all_label_indxs", T.ArrayType(T.FloatType())),
    T.StructField("is_train", T.IntegerType()),
    T.StructField("pred_proba_label_indxs", T.ArrayType(T.FloatType())),
    T.StructField("predicted_label_indxs", T.ArrayType(T.IntegerType())),
    T.StructField("predicted_labels", T.ArrayType(T.StringType())),
    T.StructField("label_indxs", T.ArrayType(T.IntegerType())),
    T.StructField("labels", T.ArrayType(T.StringType())),
])

MODEL = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("token", T.StringType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
])

METRIC_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("epoch", T.DoubleType()),
    T.StructField("kind", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


class Splits(NamedTuple):
    """A dataset: its train and test examples and its label dimension."""

    train: DataFrame
    test: DataFrame
    labels: DataFrame


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to ``schema``; a null in a NOT NULL column fails the job that reads the row.

    Columns in ``keep`` are carried along in front.
    """
    columns = [F.col(name) for name in keep]
    for field in schema:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            missing = F.raise_error(F.lit(f"null in NOT NULL column {field.name}"))
            value = F.coalesce(value, missing.cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)
