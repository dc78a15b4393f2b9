import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from lexiloom.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen, again = set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)]


@given(st.lists(st.sampled_from(["a", "b", "é", " ", "\n", "\t", "#", "%", "A", "\x0b", "😀", " ", "a b c "]), max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts(parts):
    text = "".join(parts)
    assert rules.counts_of(text)[:5] == plain(text)


def test_list_finds_planted_conjunction():
    rng = np.random.default_rng(0)
    values = {name: rng.random(4000) for name in ("a", "b", "c")}
    bad = (values["a"] > 0.7) & (values["b"] <= 0.4)
    found = rules.learn(values, bad, rng.random(4000) < 0.33)
    hit = np.zeros(4000, dtype=bool)
    for rule in found:
        hit |= rules.covers(rule, values, 4000)
    assert (hit == bad).mean() > 0.98


def test_covering_goes_on_after_a_rejected_rule():
    """The first rule that is grown covers a noisy corner and is dropped; the clean one after it is found all the same."""
    rng = np.random.default_rng(2)
    n = 900
    values = {"a": rng.random(n), "b": rng.random(n)}
    noisy = values["a"] > 0.8
    clean = values["b"] > 0.95
    bad = clean | noisy & (rng.random(n) < 0.6)
    part = np.arange(n) % 3 == 0
    found = rules.learn(values, bad, part, max_conditions=1)
    assert found
    for at, rule in enumerate(found):
        before = np.zeros(n, dtype=bool)
        for other in found[:at]:
            before |= rules.covers(other, values, n)
        hit = rules.covers(rule, values, n) & ~before
        assert bad[hit].mean() >= 0.9 and bad[hit & part].mean() >= 0.9 and (bad & hit).sum() >= 5
    every = np.zeros(n, dtype=bool)
    for rule in found:
        every |= rules.covers(rule, values, n)
    assert (every & clean).sum() > 0.8 * clean.sum()


def test_best_condition_by_trying_all():
    """The gain of the chosen condition is that of the best one among all cuts between values."""
    rng = np.random.default_rng(3)
    for _ in range(30):
        values = {name: rng.integers(0, 8, 40).astype(float) for name in ("a", "b")}
        bad = rng.random(40) < 0.3
        if bad.all() or not bad.any():
            continue
        before = np.log2(bad.mean())

        def gain(hit):
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            return p * (np.log2(p / (p + n)) - before) if p else -1.0

        tried = [gain(hit) for c in values.values() for cut in np.arange(-0.5, 8, 0.5) for hit in (c > cut, c <= cut)]
        best, condition = rules._best_condition(values, bad, 256)
        if condition is not None:
            assert abs(best - gain(condition.holds(values))) < 1e-9
        assert best >= max(0.0, max(tried)) - 1e-9


def test_list_is_learned_from_few_labels(spark):
    """At 399 labelled rows the list finds what the base rule leaves."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    found = rules.fit(docs, labels)
    judged = rules.judge(docs, found).join(labels, "doc_id").collect()
    low = [r for r in judged if r.quality == 0 and not r.base_failed]
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    assert found and sum(not r.kept for r in low) >= 0.9 * len(low) > 10
    assert sum(r.kept for r in good) >= 0.98 * len(good)


def test_parts_hold_both_classes():
    for n_bad in (3, 7, 58):
        bad = np.arange(100) < n_bad
        part = rules.parts(np.arange(100) * 17, bad)
        assert part[bad].sum() == n_bad // 3 and part[~bad].sum() == (100 - n_bad) // 3


def test_expression_agrees_with_numpy(spark):
    rng = np.random.default_rng(1)
    values = {"words": rng.integers(0, 200, 500).astype(float), "upper_case": rng.random(500).round(2)}
    found = [
        (rules.Condition("words", True, 50.0), rules.Condition("upper_case", False, 0.3)),
        (rules.Condition("upper_case", True, 0.9),),
    ]
    want = ~(rules.covers(found[0], values, 500) | rules.covers(found[1], values, 500))
    df = spark.createDataFrame(list(zip(values["words"].tolist(), values["upper_case"].tolist())), "words double, upper_case double")
    columns = {name: df[name] for name in values}
    assert [r[0] for r in df.select(rules.verdict(found, columns)).collect()] == want.tolist()


def test_odd_rows(spark, odd_docs, small_labels):
    found = rules.fit(odd_docs, small_labels.limit(0))
    assert found == []
    rows = rules.judge(odd_docs, found).collect()
    assert len(rows) == odd_docs.count()
    assert all(not r.kept for r in rows if r.doc_id in (1, 2, 3, 4, 7))
    kept = rules.keep_good(odd_docs, found)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 8] or sorted(r.doc_id for r in kept.collect()) == []
    assert rules.judge(odd_docs.limit(0), found).count() == 0
