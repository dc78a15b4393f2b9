"""Row numbers over a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexiloom.operators.staging import settle

_POSITION_BITS = 33


def dense_index(df: DataFrame, order: list[str | Column], name: str = "idx") -> DataFrame:
    """Number rows 0, 1, 2, ... in ``order`` without bringing them into one task.

    Rows are range-partitioned and sorted; each partition numbers its own rows and adds the count of
    the partitions before it. ``order`` must end in a unique key, so that rows with equal leading
    values can be split over partitions. The numbered rows are settled because the range bounds
    come from a sample: positions and offsets must belong to the same run.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = settle(placed).withColumn("_part", F.shiftright("_place", _POSITION_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + place)
        .drop("_part", "_place", "_before")
    )
