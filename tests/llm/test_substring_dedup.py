"""Repeated passages against a count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lexiloom.llm import substring_dedup


def plain(rows, window):
    docs = [(i, (text or "").encode().split()) for i, text in rows]
    seen = Counter(tuple(words[i : i + window]) for _, words in docs for i in range(len(words) - window + 1))
    out = []
    for i, words in docs:
        keep = [True] * len(words)
        for a in range(len(words) - window + 1):
            if seen[tuple(words[a : a + window])] > 1:
                keep[a : a + window] = [False] * window
        kept = b" ".join(word for word, stays in zip(words, keep) if stays)
        out.append((i, len(words), len(words) - sum(keep), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def by_operator(df, **options):
    return sorted(map(tuple, substring_dedup.report(substring_dedup.remove_repeats(df, **options)).collect()), key=str)


def texts(seed):
    """Shared passages whole and cut, runs of one word, periodic texts, texts over two words."""
    values = random.Random(seed)
    passages = [[values.choice("abcdefghij") for _ in range(values.randint(3, 60))] for _ in range(6)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(values.randint(0, 6)):
            kind = values.random()
            if kind < 0.3:
                words += [values.choice("ab") for _ in range(values.randint(1, 30))]
            elif kind < 0.5:
                words += [values.choice("abcdefghijklmnop") for _ in range(values.randint(1, 50))]
            elif kind < 0.6:
                words += ["a"] * values.randint(1, 50)
            elif kind < 0.7:
                words += ["a", "b", "c"][: values.randint(1, 3)] * values.randint(1, 20)
            else:
                passage = values.choice(passages)
                words += passage[values.randrange(len(passage)) :]
        rows.append((i if values.random() < 0.9 else 3, " ".join(words)))
    return rows + rows[:3] + [(None, None), (None, "x"), (None, rows[5][1]), (None, rows[5][1]), (7, "")]


@pytest.mark.parametrize(
    "seed,window,options",
    [(0, 8, {"rounds": 3}), (1, 8, {"unit_words": 300, "range_entries": 50}), (2, 20, {"unit_words": 100, "range_entries": 100}), (3, 35, {})],
)
def test_equals_count_of_all_windows(spark, seed, window, options):
    rows = texts(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain(rows, window)
    assert sum(row[2] for row in want) > 100
    assert by_operator(df, window=window, **options) == want


def test_documents(spark, small_docs):
    rows = list(map(tuple, small_docs.select("doc_id", "text").collect()))
    assert by_operator(small_docs) == plain(rows, 35)


def test_odd_rows_and_empty_table(spark, odd_docs):
    clash = odd_docs.withColumnRenamed("labels", "key").withColumnRenamed("source", "covered")
    rows = list(map(tuple, odd_docs.select("doc_id", "text").collect()))
    assert by_operator(clash) == plain(rows, 35)
    assert by_operator(odd_docs.limit(0)) == []


def test_equal_windows_have_equal_anchors():
    """The property that the counting rests on, over texts of few words."""
    values = random.Random(5)
    for rounds in (1, 3, 6):
        rows = [[values.choice(["a", "b", "c"]).encode() for _ in range(values.randint(12, 60))] for _ in range(200)]
        sizes = np.array([len(row) for row in rows])
        hashes = substring_dedup.hashes_of([word for row in rows for word in row])
        found = {}
        for name, text, first, last, start in zip(*(x.tolist() for x in substring_dedup.anchors(hashes, sizes, 12, rounds))):
            for at in range(first, last + 1):
                window = tuple(rows[text][at : at + 12])
                assert found.setdefault(window, (name, start - at)) == (name, start - at)
        assert sum(sizes - 11) >= len(found) > 100
