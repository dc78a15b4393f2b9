"""Lookups of small and large dimension tables without skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexiloom.config import BROADCAST_BYTES
from lexiloom.operators.staging import fits, measure, settle

# A key that holds at least one row in this many is heavy, so there are never more heavy keys than this.
# The smaller numbers are for dimension rows so wide that the heavy ones would not fit otherwise.
HEAVY_SHARES = (10_000, 1_000, 100)


def key_counts(df: DataFrame, key: str) -> tuple[DataFrame, int, int]:
    """Rows per key, rows with a key and rows without one."""
    counts = settle(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")))
    has_key = F.col(key).isNotNull()
    sums = counts.agg(
        F.coalesce(F.sum(F.when(has_key, F.col("_n"))), F.lit(0)).alias("keyed"),
        F.coalesce(F.sum(F.when(~has_key, F.col("_n"))), F.lit(0)).alias("blank"),
    ).first()
    return counts.where(has_key), sums["keyed"], sums["blank"]


def heavy_keys(counts: DataFrame, keyed: int, share: int) -> DataFrame:
    """Keys holding at least 1/share of the keyed rows: at most ``share`` keys."""
    return counts.where(F.col("_n") * share >= F.lit(keyed)).drop("_n")


def lookup_join(
    df: DataFrame, dim: DataFrame, key: str, how: str = "left", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join ``dim`` (unique on ``key``) to ``df``; ``how`` is left or inner.

    A dimension measured within ``limit`` is broadcast. A larger one is joined by shuffle, except
    for the heavy keys of ``df``: their few dimension rows are broadcast, so no task receives
    more than a small share of the rows whatever the key distribution is. ``df`` is then settled, because
    it is read several times: pass only the columns the join needs.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    if fits(dim, limit):
        return df.join(F.broadcast(dim), key, how)
    df = settle(df)
    extra = [name for name in dim.columns if name != key]
    counts, keyed, blank_rows = key_counts(df, key)
    found = dim.withColumn("_found", F.lit(True))
    for share in HEAVY_SHARES:
        head = settle(heavy_keys(counts, keyed, share).join(found, key, "left"))
        if fits(head):
            break
    else:
        # A hundred rows beyond the limit: too wide to broadcast, left to the adaptive skew join.
        return df.join(dim, key, how)
    hot = df.join(F.broadcast(head), key, "inner")
    if how == "inner":
        hot = hot.where("_found")
    cold = df.join(F.broadcast(head.select(key)), key, "left_anti")
    if how == "left" and blank_rows:
        # Rows without a key match nothing and must not meet in one task.
        named = cold.where(F.col(key).isNotNull()).join(dim, key, "left")
        blank = cold.where(F.col(key).isNull()).select(
            "*", *[F.lit(None).cast(dim.schema[name].dataType).alias(name) for name in extra]
        )
        cold = named.unionByName(blank)
    else:
        cold = cold.join(dim, key, how)
    return hot.drop("_found").unionByName(cold)


def positions_of(df: DataFrame, key: str, items: str | Column) -> DataFrame:
    """(key, pos, item) of the elements of an array column.

    The outer form keeps Spark from adding a filter on the array below the explode, which would
    compute an array expression a second time.
    """
    return df.select(key, F.posexplode_outer(items).alias("pos", "item")).where(F.col("pos").isNotNull())


def with_value(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Attach the single value of a one-row, one-column table as a scalar subquery.

    Use the new column exactly once in the next ``select``: Spark then folds the two projections
    into one and tasks read the value in place instead of copying it into every row.
    """
    return df.select("*", one_row.scalar().alias(name))


def hash_buckets(
    table: DataFrame, key: str, value: str, limit: int = BROADCAST_BYTES
) -> tuple[DataFrame, int] | None:
    """Pack a table into one array of small maps, addressed by the hash of the key; None if it exceeds ``limit``.

    Looking up a key inside an array expression then touches one map of about one entry.
    """
    rows, size = measure(table)
    if size > limit:
        return None
    buckets = 1 << max(4, (max(rows, 1) - 1).bit_length())
    entries = table.select(
        bucket_of(F.col(key), buckets).alias("b"), F.struct(F.col(key).alias("k"), F.col(value).alias("v")).alias("e")
    )
    # Every bucket gets a row without an entry; the list leaves nulls out.
    rows_of_buckets = table.sparkSession.range(buckets).select(
        F.col("id").cast("int").alias("b"), F.lit(None).cast(entries.schema["e"].dataType).alias("e")
    )
    filled = entries.unionByName(rows_of_buckets).groupBy("b").agg(F.collect_list("e").alias("e"))
    ordered = F.sort_array(F.collect_list(F.struct("b", "e")))
    return filled.agg(F.transform(ordered, lambda x: F.map_from_entries(x["e"])).alias("buckets")), buckets


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def find(buckets: Column, key: Column, n: int) -> Column:
    """Value of ``key`` in the array built by :func:`hash_buckets`, or null."""
    return F.element_at(F.get(buckets, bucket_of(key, n)), key)


def dense_array(table: DataFrame, position: str, value: str) -> DataFrame:
    """One-row array of a measured table whose positions are 0..n-1."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), F.col(value).alias("v"))))
    return table.agg(F.transform(pairs, lambda x: x["v"]).alias("items"))
