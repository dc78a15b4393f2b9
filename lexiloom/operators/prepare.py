"""From raw splits to example tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexiloom.config import SEED
from lexiloom.operators.lookup import lookup_join
from lexiloom.operators.ordering import dense_index
from lexiloom.operators.staging import fits, settle
from lexiloom.schemas import LABELS, MULTI_LABEL_EXAMPLES, SINGLE_LABEL_EXAMPLES, conform


def single_label_examples(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to (text, label), both NOT NULL, label as bigint."""
    return conform(df, SINGLE_LABEL_EXAMPLES, keep)


def label_columns(df: DataFrame, text_col: str = "Tweet", id_col: str = "ID") -> list[str]:
    """All columns but the id and the text are labels."""
    return [name for name in df.columns if name not in (id_col, text_col)]


def multi_label_pack(
    df: DataFrame, flags: list[str], text_col: str = "Tweet", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Boolean label columns to one array: 1.0 for true, 0.0 for false or null, in column order."""
    slots = [F.when(F.col(name), 1.0).otherwise(0.0).cast("float") for name in flags]
    packed = df.select(*keep, F.col(text_col).alias("text"), F.array(*slots).alias("labels"))
    return conform(packed, MULTI_LABEL_EXAMPLES, keep)


def label_dimension_of_columns(spark: SparkSession, names: list[str]) -> DataFrame:
    """(idx, label) of declared label names or label columns, in their order."""
    return spark.createDataFrame(list(enumerate(names)), LABELS)


def label_dimension(df: DataFrame, name_col: str) -> DataFrame:
    """(idx, label) of the distinct names found in a column, in name order."""
    names = settle(df.where(F.col(name_col).isNotNull()).select(F.col(name_col).alias("label")).distinct())
    if fits(names):
        # The measured list of names is small enough for one task.
        numbered = names.withColumn("idx", F.row_number().over(Window.orderBy("label")) - 1)
    else:
        numbered = dense_index(names, ["label"])
    return numbered.select(F.col("idx").cast("int").alias("idx"), "label")


def rename_prune(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Call the text column ``text`` and keep only the named columns."""
    return df.withColumnRenamed(text_col, "text").select(*keep)


def split_flag(df: DataFrame, is_train: bool) -> DataFrame:
    return df.withColumn("is_train", F.lit(1 if is_train else 0))


def split_filter(df: DataFrame, is_train: bool) -> DataFrame:
    return df.where(F.col("is_train") == (1 if is_train else 0))


def shuffle_rows(df: DataFrame, key: list[str], seed: int = SEED) -> DataFrame:
    """Permute rows; the same seed gives the same order, also when a task runs again.

    ``key`` must be unique: it decides the place of a row.
    """
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), *key)


def _required(value, known, message: str, data_type: str):
    missing = known & value.isNull()
    return F.when(missing, F.raise_error(F.lit(message)).cast(data_type)).otherwise(value)


def attach_label_name(
    df: DataFrame, labels: DataFrame, index_col: str = "label", name_col: str = "label_name", strict: bool = True
) -> DataFrame:
    """Label index to name; in strict mode an index that is not in the dimension fails the job."""
    dim = labels.select(F.col("idx").alias(index_col), F.col("label").alias("_name"))
    dim = dim.withColumn(index_col, F.col(index_col).cast(df.schema[index_col].dataType))
    joined = lookup_join(df, dim, index_col)
    name = F.col("_name")
    if strict:
        name = _required(name, F.col(index_col).isNotNull(), "label index is not in the label table", "string")
    return joined.withColumn(name_col, name).select(*[c for c in df.columns if c != name_col], name_col)


def label_to_index(
    df: DataFrame, labels: DataFrame, name_col: str = "label_name", index_col: str = "label", strict: bool = True
) -> DataFrame:
    """Label name to index."""
    dim = labels.select(F.col("label").alias(name_col), F.col("idx").alias("_idx"))
    joined = lookup_join(df, dim, name_col)
    index = F.col("_idx")
    if strict:
        index = _required(index, F.col(name_col).isNotNull(), "label name is not in the label table", "int")
    return joined.withColumn(index_col, index.cast("long")).select(
        *[c for c in df.columns if c != index_col], index_col
    )


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """All rows of both splits with ``is_train`` 1 or 0; duplicates stay."""
    return split_flag(train, True).unionByName(split_flag(test, False))


def merge_validation(train: DataFrame, validation: DataFrame) -> DataFrame:
    return train.unionByName(validation)


def merge_all_splits(train: DataFrame, validation: DataFrame, test: DataFrame) -> DataFrame:
    """Train, validation and test in one table; validation counts as train."""
    return union_train_test(merge_validation(train, validation), test)
