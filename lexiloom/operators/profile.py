"""Counts, lengths and exact quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lexiloom.functions.text import space_length

# The quantile grids. The deciles are the doubles that repeated steps of 0.1 give.
QUARTILES = [0.25, 0.5, 0.75]
DECILES = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6, 0.7000000000000001, 0.8, 0.9]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, in one job."""
    marked = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("split"))
        marked = part if marked is None else marked.unionByName(part)
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def non_null_rows(df: DataFrame) -> DataFrame:
    """Rows whose first column is not null."""
    return df.agg(F.count(F.col(df.columns[0])).alias("n_rows"))


def token_lengths(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, space_length(text).alias("token_length"))


def length_histogram(df: DataFrame, length: str = "token_length", count: str = "n_rows") -> DataFrame:
    return df.groupBy(length).agg(F.count(F.lit(1)).alias(count))


def token_length_histogram(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows per length, ascending."""
    return order_by_length(length_histogram(token_lengths(df, text)))


def order_by_length(histogram: DataFrame, length: str = "token_length") -> DataFrame:
    return histogram.orderBy(length)


def histogram_quantiles(
    histogram: DataFrame, probabilities: list[float], value: str = "token_length", weight: str | None = "n_rows"
) -> DataFrame:
    """Exact quantiles, one row per probability; every answer is a value of the table.

    The answer for p over n rows is the value of rank ceil(p * n). With ``weight`` a histogram row
    counts that many times, without it once. The running count is over distinct lengths, not rows:
    d distinct lengths need a corpus of at least d * (d - 1) / 2 tokens, so a few million at most.
    """
    weights = F.when(F.col(value).isNull(), 0).otherwise(F.col(weight) if weight else 1)
    weighted = histogram.select(value, weights.cast("long").alias("_w"))
    upto = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = weighted.select(value, F.sum("_w").over(upto).alias("_upto"), F.sum("_w").over(everything).alias("_n"))
    picks = [
        F.struct(
            F.lit(p).alias("probability"),
            F.min(F.when(F.col("_upto") >= F.greatest(F.ceil(F.lit(p) * F.col("_n")), F.lit(1)), F.col(value))).alias(
                value
            ),
        )
        for p in probabilities
    ]
    return running.agg(F.array(*picks).alias("_picks")).select(F.inline("_picks"))


def length_quantiles(df: DataFrame, probabilities: list[float], text: str = "text") -> DataFrame:
    """Quantiles of the text lengths over rows, from their histogram."""
    return histogram_quantiles(length_histogram(token_lengths(df, text)), probabilities)


def leaked_rows(train: DataFrame, test: DataFrame, text: str = "text") -> DataFrame:
    """Test rows whose text also occurs in train. Copies are counted per text before the splits meet."""
    sides = train.select(F.sha2(text, 256).alias("_h"), F.lit(0).alias("_test")).unionByName(
        test.select(F.sha2(text, 256).alias("_h"), F.lit(1).alias("_test"))
    )
    per_text = sides.groupBy("_h").agg(
        F.sum("_test").alias("_tests"), F.sum(F.lit(1) - F.col("_test")).alias("_trains")
    )
    leaked = F.when(F.col("_trains") > 0, F.col("_tests")).otherwise(0)
    return per_text.agg(
        F.coalesce(F.sum("_tests"), F.lit(0)).alias("test_rows"), F.coalesce(F.sum(leaked), F.lit(0)).alias("leaked_rows")
    )
