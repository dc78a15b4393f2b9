"""Scoring and decoding of streams; every step works on one row, so no state is kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A stream of the parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop; the sink writes each row once, also after a restart."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def each_batch_available(
    df: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Run a batch operator on every micro-batch; a batch that runs again replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
