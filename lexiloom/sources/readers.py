"""Reading splits and tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lexiloom.config import MULTI_LABEL, Dataset, dataset
from lexiloom.operators.prepare import label_columns, label_dimension_of_columns, multi_label_pack
from lexiloom.schemas import LABELS, SINGLE_LABEL_EXAMPLES, Splits, conform


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A saved table by name, or a parquet path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_split(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", schema: T.StructType | None = None, **options
) -> DataFrame:
    """One split from parquet, json or csv files; text formats need a schema, nothing is inferred."""
    if fmt not in ("parquet", "json", "csv", "orc", "delta"):
        raise ValueError(f"unknown format {fmt!r}")
    if fmt in ("json", "csv") and schema is None:
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def load_splits(
    spark: SparkSession,
    name: str | Dataset,
    paths: dict[str, str | list[str]],
    label_names: list[str] | DataFrame | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    text_col: str | None = None,
    **options,
) -> Splits:
    """Load a named dataset as train, test and label tables.

    ``paths`` maps train, test and, if there is one, validation to files; validation rows join train.
    ``label_names`` are the class names in declared order, or a label table. A multi-label
    source has one boolean column per label besides ``ID`` and the text column.
    """
    info = name if isinstance(name, Dataset) else dataset(name)
    parts = {split: read_split(spark, path, fmt, schema, **options) for split, path in paths.items()}
    unknown = set(parts) - {"train", "test", "validation"}
    if unknown or not {"train", "test"} <= set(parts):
        raise ValueError("paths must name train and test, and may name validation")
    if info.problem_type == MULTI_LABEL:
        text_col = text_col or "Tweet"
        flags = label_columns(parts["train"], text_col)
        train = parts["train"]
        if "validation" in parts:
            train = train.unionByName(parts["validation"])
        labels = label_dimension_of_columns(spark, flags)
        return Splits(
            multi_label_pack(train, flags, text_col), multi_label_pack(parts["test"], flags, text_col), labels
        )
    if label_names is None or isinstance(label_names, list) and not label_names:
        raise ValueError("a single-label dataset needs its class names in declared order")
    renamed = {k: v.withColumnRenamed(text_col, "text") if text_col else v for k, v in parts.items()}
    if isinstance(label_names, DataFrame):
        labels = conform(label_names, LABELS)
    else:
        labels = spark.createDataFrame(list(enumerate(label_names)), LABELS)
    train, test = (conform(renamed[split], SINGLE_LABEL_EXAMPLES) for split in ("train", "test"))
    if "validation" in renamed:
        train = train.unionByName(conform(renamed["validation"], SINGLE_LABEL_EXAMPLES))
    return Splits(train, test, labels)


def without_scheme(path: str) -> str:
    """Drop a file system scheme: ``file:///a`` becomes ``/a``, ``s3a://b/a`` becomes ``/b/a``."""
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:/*", "/", path)


def table_files(df: DataFrame) -> DataFrame:
    """Files behind a file-based table, without their scheme, and the rows in each; files without rows, too."""
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*:/*", "/")
    counts = df.select(path.alias("file_path")).groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
    # The driver plans a scan with this list anyway.
    listed = df.sparkSession.createDataFrame([(name,) for name in file_list(df)], "file_path string")
    return listed.join(counts, "file_path", "left").select("file_path", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def file_list(df: DataFrame) -> list[str]:
    return sorted(without_scheme(path) for path in df.inputFiles())


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Give the rows of a parquet table a unique key that is the same on every read: file and row in file."""
    return df.select(
        F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")).alias(name), "*"
    )


def spread(df: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """Spread rows by a hash of their unique key, for an input with fewer files than there are cores; None: as read."""
    return df if partitions is None else df.repartition(partitions, key)
