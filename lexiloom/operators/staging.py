"""Reliable intermediate results and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lexiloom.config import BROADCAST_BYTES

ROW_OVERHEAD = 32
#: Of intermediate results: denser than the default, as they are written once and read a few times.
COMPRESSION = "zstd"
# Bytes of an element of an array; others take 8.
_BYTES = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate results: the session's ``spark.checkpoint.dir``.

    Only a local session may go without one; a cluster must name a folder all executors see.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="lexiloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{staging_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute once and keep in the shared folder, so later uses see the same rows after a lost executor.

    Kept as Parquet: compressed, and later uses read only the columns they need.
    """
    path = fresh_path(df.sparkSession, "settled")
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front of it, so that no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_stable_key(df: DataFrame, name: str) -> DataFrame:
    """``df``, settled, with a unique key that is the same whenever it is read."""
    return settle(df.withColumn(name, F.monotonically_increasing_id()))


#: Database of the tables of :class:`Scratch`; its folder lies in the shared folder.
SCRATCH = "lexiloom_scratch"


class Scratch:
    """Intermediate tables in the shared folder whose files are deleted as soon as they are not needed any more.

    A table can be kept in buckets of a key: joins and groupings by that key then find its rows where they lie.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.names: dict[int, tuple[DataFrame, str]] = {}
        folder = f"{staging_dir(spark).rstrip('/')}/tables"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH} LOCATION '{folder}'")

    def keep(self, df: DataFrame, key: str | None = None, buckets: int = 0, placed: bool = False) -> DataFrame:
        """``placed``: the rows of a bucket are in one task already, as after a join with a table in such buckets."""
        name = f"{SCRATCH}.t{uuid.uuid4().hex}"
        if key:
            dealt = df if placed else df.repartition(buckets, key)
            dealt.write.option("compression", COMPRESSION).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
        else:
            df.write.option("compression", COMPRESSION).saveAsTable(name)
        kept = self.spark.table(name)
        self.names[id(kept)] = kept, name
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that :meth:`keep` returned; other ones are left alone."""
        for table in tables:
            if id(table) in self.names:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop(id(table))[1]}")

    def close(self) -> None:
        self.drop(*[table for table, _ in self.names.values()])


def _width(value, data_type: T.DataType):
    """Bytes a value takes, as an expression."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(8)
    if isinstance(data_type, T.ArrayType):
        element = data_type.elementType
        if isinstance(element, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            zero = F.lit(8).cast("long")
            total = F.aggregate(value, zero, lambda acc, x: acc + _width(x, element).cast("long"))
            return F.coalesce(total, zero)
        return F.coalesce(F.size(value), F.lit(0)).cast("long") * _BYTES.get(type(element), 8) + F.lit(8)
    if isinstance(data_type, T.MapType):
        return _width(F.map_keys(value), T.ArrayType(data_type.keyType)) + _width(
            F.map_values(value), T.ArrayType(data_type.valueType)
        )
    if isinstance(data_type, T.StructType):
        total = F.lit(8)
        for field in data_type:
            total = total + _width(value[field.name], field.dataType)
        return total
    return F.lit(8)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table, counted by one aggregation."""
    total = F.lit(ROW_OVERHEAD).cast("long")
    for field in df.schema:
        total = total + _width(F.col(field.name), field.dataType)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the whole table was measured to be within ``limit`` bytes."""
    return measure(df)[1] <= limit
