"""Collocations against SQL over the same rows, and automata against counting."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from lexiloom.llm import automata, collocations

SMALL = "/root/testdata/sf0.001"


def by_sql(df):
    con = duckdb.connect()
    con.register("documents", df.select("lang", "text").toPandas())
    return sorted(con.execute(collocations.ORACLE).fetchall())


@pytest.mark.parametrize("sizes", [{}, {"range_bytes": 20_000, "shard_words": 3_000}])
def test_equals_sql(spark, small_docs, sizes):
    got = collocations.collocations(small_docs, **sizes)
    assert sorted(map(tuple, got.collect())) == by_sql(small_docs)


@pytest.mark.parametrize("seed", range(3))
def test_equals_sql_on_few_words(spark, seed):
    """Few words, so that phrases overlap themselves, scores tie and longer phrases hide shorter ones."""
    values = random.Random(seed)
    rows = []
    for i in range(120):
        words = [values.choice(["a", "B", "ab", "é", "ÉE", "x-y", "_"]) + values.choice(["", "", ".", ", ", "\n", ";;"]) for _ in range(values.randint(0, 40))]
        rows.append((values.choice(["en", None, "und", ""]), values.choice([" ", "  ", "\t", " \t"]).join(words)))
    rows += [(None, None), ("en", None), ("zz", ""), ("zz", "alone in its language"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = collocations.collocations(df, range_bytes=500, shard_words=200)
    assert sorted(map(tuple, got.collect())) == by_sql(df)


def test_one_phrase_everywhere(spark):
    """A text longer than a shard, and windows that cross its parts."""
    df = spark.createDataFrame([("en", "the same " * 5_000)], "lang string, text string")
    got = collocations.collocations(df, shard_words=101, range_bytes=1_000).collect()
    assert sorted(map(tuple, got)) == by_sql(df)


def test_clashing_columns_and_empty_table(spark, odd_docs):
    clash = odd_docs.withColumnRenamed("labels", "data").withColumnRenamed("n_words", "range")
    assert sorted(map(tuple, collocations.collocations(clash).collect())) == by_sql(odd_docs)
    assert collocations.collocations(odd_docs.limit(0)).isEmpty()


def test_numbers_beyond_64_bits():
    """The score of counts whose products pass 64 bits, as the operator computes it."""
    a, left, right = 3 * 10**12, 4 * 10**12, 5 * 10**12
    assert 1_000_000 * a * a // (left * right) == 450_000


def counted(texts):
    found = Counter()
    for words in texts:
        for i in range(len(words)):
            for n in (1, 2, 3):
                if i + n <= len(words):
                    found[tuple(words[i : i + n])] += 1
    return found


def paths_of(texts):
    shard = collocations._Shard()
    words = b" . ".join(b" ".join(text) for text in texts).split()
    shard.add(words, len(words))
    return shard.paths()


def listed(paths):
    w = paths.words
    found = Counter({(w[i],): n for i, n in zip(paths.singles.tolist(), paths.single_counts.tolist())})
    pairs = [(w[key >> 32], w[key & 0xFFFFFFFF]) for key in paths.pairs.tolist()]
    found.update(dict(zip(pairs, paths.pair_counts.tolist())))
    triples = zip(paths.triple_pairs.tolist(), paths.thirds.tolist(), paths.triple_counts.tolist())
    found.update({(*pairs[p], w[t]): n for p, t, n in triples})
    return found


@pytest.mark.parametrize("seed", range(5))
def test_automata_count_like_a_counter(seed):
    values = random.Random(seed)
    word = lambda: values.choice([b"a", b"b", b"cc", b"d", b"\xc3\xa9"][: seed + 1])
    one, two = ([[word() for _ in range(values.randint(1, 9))] for _ in range(values.randint(1, 40))] for _ in range(2))
    a, b = paths_of(one), paths_of(two)
    assert listed(a) == counted(one)
    again = automata.from_bytes(automata.to_bytes(a))
    assert listed(again) == listed(a) and (np.diff(again.pairs) > 0).all()
    both = automata.union([automata.from_bytes(automata.to_bytes(x)) for x in (a, b)])
    assert listed(both) == counted(one + two)
    assert listed(both.at_least(5)) == {k: n for k, n in counted(one + two).items() if n >= 5}
    asked = automata.acceptor(a.words, a.singles, a.pairs)
    answer = listed(automata.compose(asked, b))
    assert answer == {k: counted(two)[k] for k in counted(one) if len(k) < 3}


def test_equal_states_are_kept_once():
    """Thousands of words with the same followers share their states."""
    texts = [[b"w%d" % i, b"of", b"the"] for i in range(5_000)]
    paths = paths_of(texts)
    state, first = automata._merged_states(np.bincount(paths.triple_pairs, minlength=len(paths.pairs)), paths.thirds, paths.triple_counts)
    assert len(state) == 5_001 and len(first) == 2


def test_parts_that_are_united_in_several_rounds(spark, small_docs, monkeypatch):
    monkeypatch.setattr(collocations, "WAITING_PATHS", 3_000)
    got = collocations.collocations(small_docs, range_bytes=60_000, shard_words=3_000)
    assert sorted(map(tuple, got.collect())) == by_sql(small_docs)
