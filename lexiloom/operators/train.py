"""Text classifiers trained by counting: one table of token weights and a bias row."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from lexiloom.config import MULTI_LABEL, SINGLE_LABEL
from lexiloom.functions.text import tokens
from lexiloom.functions.vectors import bind
from lexiloom.operators.lookup import lookup_join, with_value
from lexiloom.operators.staging import settle
from lexiloom.operators.vocabulary import ranked_tokens, token_counts, words

BIAS_ID = -1

#: Up to so many outputs the counts of a token move as one row; of more, most are 0, so they move one by one first.
WIDE_OUTPUTS = 8


class Counts(NamedTuple):
    """What training needs from the corpus.

    ``tokens``: (id, token, n array<bigint>), occurrences per output; for multi-label problems the
    first half of ``n`` counts rows with the label, the second half rows without it.
    ``rows``: one row (n array<bigint>), the same for examples.
    """

    tokens: DataFrame
    rows: DataFrame
    outputs: int
    problem_type: str


class Model(NamedTuple):
    """Weights (id, token, weights array<double>); the row with id -1 holds the bias."""

    weights: DataFrame
    outputs: int
    problem_type: str


def _slots(numbers: Column, n: int) -> Column:
    """Array of n counts from a map of slot to count."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.coalesce(F.element_at(numbers, k), F.lit(0)))


def _as_slots(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """(by, label, n) rows to one array per ``by``; a group has at most one row per label."""
    entries = F.map_from_entries(F.collect_list(F.struct(F.col("label").cast("int"), F.col("n"))))
    return df.groupBy(*by).agg(_slots(entries, n).alias("n"))


def checked_labels(examples: DataFrame, outputs: int) -> DataFrame:
    """Fails the job at a label outside 0..n-1 or a list of labels of another length; adds no pass."""
    if "labels" in examples.columns:
        wrong = F.raise_error(F.lit(f"labels must have {outputs} values")).cast(examples.schema["labels"].dataType)
        return examples.withColumn("labels", F.when(F.size("labels") == outputs, F.col("labels")).otherwise(wrong))
    wrong = F.raise_error(F.lit(f"label is not in 0..{outputs - 1}")).cast(examples.schema["label"].dataType)
    return examples.withColumn("label", F.when(F.col("label").between(0, outputs - 1), F.col("label")).otherwise(wrong))


def _per_class(examples: DataFrame, outputs: int) -> DataFrame:
    """(token, c array<bigint>, n): occurrences per class and in all."""
    if 0 < outputs <= WIDE_OUTPUTS:
        exploded = examples.select("label", F.explode(tokens("text")).alias("token"))
        hits = [F.count(F.when(F.col("label") == k, F.lit(1))) for k in range(outputs)]
        return exploded.groupBy("token").agg(F.array(*hits).alias("c"), F.count(F.lit(1)).alias("n"))
    entries = F.map_from_entries(F.collect_list(F.struct(F.col("label").cast("int"), F.col("n"))))
    by_class = token_counts(examples, "text", ("label",)).groupBy("token")
    return by_class.agg(_slots(entries, outputs).alias("c"), F.sum("n").alias("n"))


def _with_ids(counts: DataFrame, vocabulary_size: int | None, vocabulary: DataFrame | None) -> DataFrame:
    """(id, token, n) of (token, c, n): the counts take their ids by rank, or those of a vocabulary that is given."""
    if vocabulary is None:
        # The shorter list is found from the counts, so they are read twice.
        found = ranked_tokens(counts if vocabulary_size is None else settle(counts), vocabulary_size)
    else:
        found = lookup_join(counts.select("token", "c"), words(vocabulary), "token", "inner")
    return found.select("id", "token", F.col("c").alias("n"))


def count_single_label(
    examples: DataFrame, outputs: int, vocabulary_size: int | None = None, vocabulary: DataFrame | None = None
) -> Counts:
    """Count tokens per class in one pass over the texts (text, label); all tokens unless a size is named."""
    examples = checked_labels(examples, outputs)
    by_token = _with_ids(_per_class(examples, outputs), vocabulary_size, vocabulary)
    classes = examples.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return Counts(by_token, _as_slots(classes, [], outputs), outputs, SINGLE_LABEL)


def count_multi_label(
    examples: DataFrame, outputs: int, vocabulary_size: int | None = None, vocabulary: DataFrame | None = None
) -> Counts:
    """Count tokens with and without each label in one pass over the texts (text, labels)."""

    def sums(one: Column) -> list[Column]:
        hits = [F.get("labels", F.lit(k)) == 1.0 for k in range(outputs)]
        yes = [F.count(F.when(hit, one)) for hit in hits]
        no = [F.count(F.when(~hit, one)) for hit in hits]
        return [F.array(*yes, *no).alias("c"), F.count(one).alias("n")]

    examples = checked_labels(examples, outputs)
    exploded = examples.select("labels", F.explode(tokens("text")).alias("token"))
    by_token = _with_ids(exploded.groupBy("token").agg(*sums(F.lit(1))), vocabulary_size, vocabulary)
    rows = examples.agg(*sums(F.lit(1))).select(F.col("c").alias("n"))
    return Counts(by_token, rows, outputs, MULTI_LABEL)


def fit(counts: Counts, smoothing: float = 1.0) -> Model:
    """Naive Bayes weights of the counts."""
    return fit_grid(counts, [smoothing])


def fit_grid(counts: Counts, smoothings: list[float]) -> Model:
    """Weights for several smoothing values side by side: output k of value i is slot i * outputs + k.

    Single label: log share of the token among the tokens of the class; bias: log share of the class.
    Multi label: difference of those between rows with and without the label.
    """
    if any(s <= 0 for s in smoothings):
        raise ValueError("smoothing must be positive")
    width = counts.outputs * (2 if counts.problem_type == MULTI_LABEL else 1)
    sums = counts.tokens.agg(
        F.array(*[F.coalesce(F.sum(F.get("n", F.lit(k))), F.lit(0)) for k in range(width)]).alias("t"),
        F.count(F.lit(1)).alias("v"),
    ).select(F.struct("t", "v").alias("sums"))

    def share(n: Column, total: Column, smoothing: float, parts: Column) -> Column:
        return F.log((n + F.lit(smoothing)) / (total + F.lit(smoothing) * parts))

    def joined(values: list[Column]) -> Column:
        return F.concat(*values) if len(values) > 1 else values[0]

    def contrast(logs: Column) -> Column:
        if counts.problem_type != MULTI_LABEL:
            return logs
        half = counts.outputs
        return F.zip_with(F.slice(logs, 1, half), F.slice(logs, half + 1, half), lambda a, b: a - b)

    def token_weights(s: Column) -> Column:
        return joined([
            contrast(F.zip_with("n", s["t"], lambda n, t: share(n, t, smoothing, s["v"]))) for smoothing in smoothings
        ])

    def bias_weights() -> Column:
        if counts.problem_type == MULTI_LABEL:
            return joined([
                contrast(F.transform("n", lambda n: F.log(n + F.lit(smoothing)))) for smoothing in smoothings
            ])
        total = F.aggregate("n", F.lit(0).cast("long"), lambda acc, x: acc + x)
        return joined([
            F.transform("n", lambda n: share(n, total, smoothing, F.lit(counts.outputs))) for smoothing in smoothings
        ])

    tokens_ = with_value(counts.tokens, "_sums", sums).select(
        "id", "token", bind(F.col("_sums"), token_weights).alias("weights")
    )
    bias = counts.rows.select(
        F.lit(BIAS_ID).alias("id"), F.lit(None).cast("string").alias("token"), bias_weights().alias("weights")
    )
    return Model(settle(tokens_.unionByName(bias)), counts.outputs * len(smoothings), counts.problem_type)


def train_single_label(
    examples: DataFrame, outputs: int, vocabulary_size: int | None = None, smoothing: float = 1.0,
    vocabulary: DataFrame | None = None,
) -> Model:
    return fit(count_single_label(examples, outputs, vocabulary_size, vocabulary), smoothing)


def train_multi_label(
    examples: DataFrame, outputs: int, vocabulary_size: int | None = None, smoothing: float = 1.0,
    vocabulary: DataFrame | None = None,
) -> Model:
    """One binary output per label, all fitted by the same job."""
    return fit(count_multi_label(examples, outputs, vocabulary_size, vocabulary), smoothing)
