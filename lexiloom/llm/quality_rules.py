"""Quality rules by learned decision lists.

Counts of every text are taken in one pass without a shuffle. A decision list is learned from labelled rows by
sequential covering: a rule is a conjunction of thresholds, grown on one part of the sample by information gain and
pruned on the other; rows it covers leave the sample, then the next rule is grown. A rule that is not good enough is dropped
and the rows it covers are set aside, so that others can still be found. The list becomes one ordered Spark conditional
expression.

Null or empty texts have zero counts, fail the base rule and are not kept. Repeated rows are judged one by one.
Labels with a null id or value, or with two values for one id, are not used. Without labels of both kinds the list is
empty and the base rule alone decides. Columns of the input that have the name of an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns, shingle_hashes, word_hashes

#: Labelled rows that the list is learned from, at most; they are the first in the order of a hash of their id.
SAMPLE_ROWS = 20_000

SYMBOLS = "#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_END_MARKS = b"!?"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_punctuation", "n_end_marks",
)


def counts_of(text: str | None) -> list[int]:
    """The values of COUNTS for one text."""
    if not text:
        return [0] * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    lines = [line for line in raw.split(b"\n") if line.translate(None, _SPACE)]
    repeats = 0
    if n >= 3:
        grams = shingle_hashes(word_hashes(words), 3)
        _, place, times = np.unique(grams, return_inverse=True, return_counts=True)
        again = times[place] >= 2
        covered = np.zeros(n, dtype=bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= again
        repeats = int(covered.sum())
    return [
        n, len(text) - count(_SPACE), count(SYMBOLS.encode()), len(lines) - len(set(lines)), repeats,
        len(lines), len(set(words)), count(_UPPER), count(_DIGITS), count(_PUNCTUATION), count(_END_MARKS),
    ]


def with_counts(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with the columns COUNTS (after ``prefix``) of the column text."""
    outputs = T.StructType([T.StructField(prefix + name, T.LongType()) for name in COUNTS])
    return append_columns(docs, ["text"], outputs, lambda lists: list(zip(*map(counts_of, lists[0]), strict=True)))


def features(prefix: str = "") -> dict[str, Column]:
    """What conditions may test: sizes and shares, 0 where there is nothing to divide by."""
    col = lambda name: F.col(prefix + name)
    share = lambda part, whole: F.when(col(whole) > 0, col(part) / col(whole)).otherwise(0.0)
    return {
        "words": col("n_words").cast("double"),
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words": share("n_distinct_words", "n_words"),
        "upper_case": share("n_upper", "word_chars"),
        "digits": share("n_digits", "word_chars"),
        "punctuation_per_word": share("n_punctuation", "n_words"),
        "end_marks_per_word": share("n_end_marks", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.feature]
        return column > self.threshold if self.above else column <= self.threshold

    def expression(self, columns: dict[str, Column]) -> Column:
        column = columns[self.feature]
        return column > F.lit(self.threshold) if self.above else column <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    found = np.ones(n, dtype=bool)
    for condition in rule:
        found &= condition.holds(values)
    return found


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray, cuts: int) -> tuple[float, Condition | None]:
    """The condition with the highest information gain for the rows ``bad``."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    best, chosen = 0.0, None
    before = np.log2(p0 / (p0 + n0))
    for name in values:
        column = values[name]
        edges = np.unique(np.quantile(column[bad], np.linspace(0, 1, cuts)))
        edges = np.unique(np.concatenate([edges, np.quantile(column, np.linspace(0, 1, cuts))]))
        if len(edges) < 2:
            continue
        marks = (edges[1:] + edges[:-1]) / 2
        p_below = np.searchsorted(np.sort(column[bad]), marks, side="right")
        n_below = np.searchsorted(np.sort(column[~bad]), marks, side="right")
        for above, p, n in ((False, p_below, n_below), (True, p0 - p_below, n0 - n_below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), -1.0)
            at = int(np.argmax(gain))
            if gain[at] > best + 1e-12:
                best, chosen = float(gain[at]), Condition(name, above, float(marks[at]))
    return best, chosen


def learn(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    prune_part: np.ndarray,
    min_precision: float = 0.9,
    min_rows: int = 5,
    max_conditions: int = 4,
    cuts: int = 64,
) -> list[Rule]:
    """Sequential covering of the rows ``bad``.

    ``prune_part`` marks the rows a grown rule is pruned on: the shortest beginning with the highest smoothed precision stays.
    A rule is accepted if at least ``min_precision`` of the rows it covers are bad, on that part (of which it must cover
    some) and over both, and if it covers ``min_rows`` bad rows over both. The rows of a rejected rule are set aside: no
    further rule is grown for them, but accepted rules still cover them, and they count in the tests of later rules.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    aside = np.zeros(len(bad), dtype=bool)
    while (bad & left & ~aside & ~prune_part).any():
        grow = left & ~aside & ~prune_part
        part = {name: column[grow] for name, column in values.items()}
        target = bad[grow]
        rule: Rule = ()
        while target.any() and not target.all() and len(rule) < max_conditions:
            gain, condition = _best_condition(part, target, cuts)
            if condition is None:
                break
            rule += (condition,)
            inside = condition.holds(part)
            part, target = {name: column[inside] for name, column in part.items()}, target[inside]
        if not rule:
            break
        test = left & prune_part
        held = {name: column[test] for name, column in values.items()}
        worth = []
        for size in range(1, len(rule) + 1):
            found = covers(rule[:size], held, int(test.sum()))
            p, n = int((found & bad[test]).sum()), int((found & ~bad[test]).sum())
            worth.append(((p + 1) / (p + n + 2), -size, p / (p + n) if p + n else 0.0))
        _, size, precision = max(worth)
        rule = rule[:-size]
        found = covers(rule, values, len(bad)) & left
        n_bad = int((found & bad).sum())
        if precision < min_precision or n_bad < min_rows or n_bad < min_precision * int(found.sum()):
            aside |= found | (grow & bad & covers(rule, values, len(bad)))
            if not (found & grow).any():
                break
        else:
            rules.append(rule)
            left &= ~found
    return rules


def parts(ids: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Marks the prune part: every third row of each class in the order of a hash of the ids, so both parts have both classes."""
    order = np.argsort(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
    part = np.zeros(len(ids), dtype=bool)
    for kind in (True, False):
        of_kind = order[bad[order] == kind]
        part[of_kind[2::3]] = True
    return part


def verdict(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """True for rows that no rule of the ordered list rejects."""
    result = None
    for rule in rules:
        test = rule[0].expression(columns)
        for condition in rule[1:]:
            test = test & condition.expression(columns)
        result = F.when(test, F.lit(False)) if result is None else result.when(test, F.lit(False))
    return F.lit(True) if result is None else result.otherwise(F.lit(True))


def base_failed(prefix: str = "") -> Column:
    n, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * again > 50 * n)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the list from ``labels`` (doc_id, quality: 0 is bad) of at most ``sample_rows`` documents."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .select("doc_id", F.col("low").alias("_quality"))
    )
    # At most sample_rows narrow rows, so this side may be broadcast and its counts may come to the driver.
    rows = with_counts(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "_q_")
    names = list(features())
    got = (
        rows.dropDuplicates(["doc_id"])
        .select("doc_id", "_quality", *[c.alias(f"_f_{name}") for name, c in features("_q_").items()])
        .toPandas()
        .sort_values("doc_id")
    )
    if got["_quality"].nunique() < 2:
        return []
    values = {name: got[f"_f_{name}"].to_numpy(dtype=float) for name in names}
    bad = got["_quality"].to_numpy() == 0
    return learn(values, bad, parts(got["doc_id"].to_numpy(), bad))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    counted = with_counts(docs.select("doc_id", "text"))
    return counted.select(
        "doc_id",
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules, features())).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the list, with their own columns."""
    prefix = "_q_"
    while any(name.lower().startswith(prefix) for name in docs.columns):
        prefix = f"_{prefix}"
    counted = with_counts(docs, prefix)
    passed = ~base_failed(prefix) & verdict(rules, features(prefix))
    return counted.where(passed).select(*[f"`{name}`" for name in docs.columns])
