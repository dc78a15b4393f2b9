"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

import lexiloom.llm
from lexiloom.operators.staging import fits, fresh_path

# Functions travel to the executors with their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(lexiloom.llm)

#: Rows whose texts are unpacked into Python objects at a time.
ROWS_AT_ONCE = 256

MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)
#: One odd factor for each place in a shingle.
PLACE_FACTORS = (
    (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xD1B54A32D192ED03)
) | np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it again, so that lineage ends here."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it was measured to be within the engine's limit, else as it is."""
    return F.broadcast(df) if fits(df) else df


def append_columns(
    df: DataFrame,
    inputs: list[str],
    outputs: T.StructType,
    function: Callable[[list[list]], list[list]],
    rows_at_once: int = ROWS_AT_ONCE,
) -> DataFrame:
    """``df`` with the columns ``outputs``, which ``function`` makes from lists of the columns ``inputs``.

    A column of ``df`` with the name of an output (in any case) is replaced. No shuffle takes place.
    """
    made = {field.name.lower() for field in outputs}
    kept = [name for name in df.columns if name.lower() not in made]
    needed = df.select(*[F.col(f"`{name}`") for name in kept], *[F.col(f"`{name}`").alias(f"_in_{i}") for i, name in enumerate(inputs)])
    schema = T.StructType([*[df.schema[name] for name in kept], *outputs])
    types = [arrow_type(field.dataType) for field in outputs]
    names = [field.name for field in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(at, rows_at_once)
                passed = batch.columns[: len(kept)]
                lists = [column.to_pylist() for column in batch.columns[len(kept) :]]
                columns = [pa.array(values, kind) for values, kind in zip(function(lists), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*passed, *columns], names=[*kept, *names])

    return needed.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind])
    return {
        T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.FloatType: pa.float32(),
        T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(),
    }[type(kind)]


def mixed(values: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every bit."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(33))
        values = values * MIX_1
        values = values ^ (values >> np.uint64(33))
        values = values * MIX_2
        return values ^ (values >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes; of the whole sequence if it is shorter; none without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - width + 1, np.uint64(width))
        for place in range(width):
            total += hashes[place : n - width + 1 + place] * PLACE_FACTORS[place]
    return mixed(total)
