"""Writing tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lexiloom.operators.staging import settle


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
               partition_by: list[str] | None = None) -> None:
    """Overwrite a table of the catalog; with ``path`` its files live there."""
    writer = df.write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
                  partition_by: list[str] | None = None) -> None:
    """Replace a table, whose schema may change; ``df`` may read the table that it replaces.

    All rows are computed and written elsewhere first, so a job that fails leaves the old table as it was. Without ``path``
    the new table is written under a name of its own and renamed, which only changes the catalog and moves a folder. With
    ``path``, or in partitions, whose folders a rename would not follow, the written rows are copied to their place.
    """
    spark = df.sparkSession
    if path or partition_by:
        ready = settle(df)
        drop_table(spark, name)
        save_table(ready, name, fmt, path, partition_by)
        return
    staged = f"{name}__{uuid.uuid4().hex}"
    try:
        save_table(df, staged, fmt, None, partition_by)
    except Exception:
        drop_table(spark, staged)
        raise
    drop_table(spark, name)
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows by an order, so that the same rows show every time."""
    return df.orderBy(*order).limit(n)
