"""Vocabulary of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lexiloom.config import SPECIAL_TOKENS
from lexiloom.functions.text import tokens
from lexiloom.operators.ordering import dense_index
from lexiloom.operators.staging import settle

FIRST_ID = max(SPECIAL_TOKENS.values()) + 1


def token_counts(df: DataFrame, text: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences of each token, optionally per value of further columns.

    Counted on the map side first, so a frequent token reaches the shuffle once per task.
    """
    exploded = df.select(*by, F.explode(tokens(text)).alias("token"))
    return exploded.groupBy("token", *by).agg(F.count(F.lit(1)).alias("n"))


def likely_tokens(counts: DataFrame, size: int) -> DataFrame:
    """At least the ``size`` most frequent tokens: all with a count that can still be in the list.

    The lowest such count is found from the number of tokens per count, so that the long tail of rare ones is not
    sorted. ``counts`` is used twice in one job; Spark reuses its exchange, so the texts behind it are read once.
    """
    # Distinct counts are few: d of them need at least d * (d - 1) / 2 token occurrences.
    per_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("_tokens"))
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    lowest = (
        per_count.withColumn("_above", F.coalesce(F.sum("_tokens").over(above), F.lit(0)))
        .where(F.col("_above") < size)
        .agg(F.coalesce(F.min("n"), F.lit(0)).alias("_lowest"))
    )
    return counts.where(F.col("n") >= lowest.scalar())


def ranked_tokens(counts: DataFrame, size: int | None) -> DataFrame:
    """``counts`` (token, n, ...) of the most frequent tokens with their ``id`` in place of ``n``; None keeps all.

    Ranks are row numbers over a range partitioning, so no task sees the whole list. Further columns travel with the
    token, so nothing has to be joined to the list afterwards.
    """
    kept = counts if size is None else likely_tokens(counts, size)
    ranked = dense_index(kept.withColumn("_down", -F.col("n")).drop("n"), ["_down", "token"], "_rank")
    if size is not None:
        ranked = ranked.where(F.col("_rank") < size)
    return ranked.withColumn("id", (F.col("_rank") + FIRST_ID).cast("int")).drop("_down", "_rank")


def vocabulary_of_counts(counts: DataFrame, size: int | None) -> DataFrame:
    """(token, id, is_special): reserved tokens, then the most frequent tokens by rank, ties by token; None keeps all.

    Settled, because everything that encodes with it must see the same ids.
    """
    ranked = ranked_tokens(counts.select("token", "n"), size).select("token", "id", F.lit(False).alias("is_special"))
    special = counts.sparkSession.createDataFrame(
        [(token, i, True) for token, i in SPECIAL_TOKENS.items()], "token string, id int, is_special boolean"
    )
    return settle(special.unionByName(ranked))


def build_vocabulary(df: DataFrame, size: int | None, text: str = "text") -> DataFrame:
    return vocabulary_of_counts(token_counts(df, text), size)


def words(vocabulary: DataFrame) -> DataFrame:
    """(token, id) without the reserved tokens."""
    return vocabulary.where(~F.col("is_special")).select("token", "id")
