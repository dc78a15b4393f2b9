"""One vector per token position, looked up in a table of token vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexiloom.config import BROADCAST_BYTES
from lexiloom.operators.lookup import lookup_join, positions_of


def token_vectors(
    encoded: DataFrame, vectors: DataFrame, key: str = "doc_id", ids: str = "input_ids", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """(key, pos, id, vector) of every position; ``vectors`` has (id, vector). Unknown ids get null."""
    positions = positions_of(encoded, key, ids).withColumnRenamed("item", "id")
    return lookup_join(positions, vectors, "id", "left", limit).select(key, "pos", "id", "vector")


def first_position_vector(
    encoded: DataFrame, vectors: DataFrame, key: str = "doc_id", ids: str = "input_ids", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """(key, id, vector) of position 0; the other positions are dropped before the lookup."""
    first = encoded.select(key, F.get(ids, F.lit(0)).alias("id"))
    return lookup_join(first, vectors, "id", "left", limit).select(key, "id", "vector")


def vector_shape(positions: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sequence length and dimension per document."""
    return positions.groupBy(key).agg(
        F.count(F.lit(1)).alias("sequence_length"), F.max(F.size("vector")).alias("dimension")
    )
