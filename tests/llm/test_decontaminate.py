import random
from collections import Counter

import numpy as np

from lexiloom.llm import decontaminate as dc
from lexiloom.llm.common import word_hashes


def test_fingerprints_of_windows():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**64, 400, dtype=np.uint64)
    for size in (1, 2, 17, 127, 128, 300):
        found = dc.Sums(hashes).windows(size)
        width, lane = (8, 8) if size <= dc.NARROW_WORDS else (4, 16)
        for start in (0, 5, len(found) - 1):
            part = hashes[start : start + size]
            want = 0
            for place in range(64 // width):
                for i in range(width):
                    votes = int(((part >> np.uint64(width * place + i)) & np.uint64(1)).sum())
                    want |= (votes > size // 2) << (lane * i + place)
            assert int(found[start]) == want


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**64, 40, dtype=np.uint64)
    near = []
    for print_ in prints.tolist():
        for flips in range(0, 16):
            value = print_
            for bit in rng.choice(64, flips, replace=False).tolist():
                value ^= 1 << bit
            near.append(value)
    windows = np.array([*near, *rng.integers(0, 2**64, 500, dtype=np.uint64).tolist()], dtype=np.uint64)
    at, member, distance = dc.Blocks(prints).within(windows, np.ones(len(windows), dtype=bool))
    found = set(zip(at.tolist(), member.tolist(), distance.tolist()))
    every = np.bitwise_count(windows[:, None] ^ prints[None, :])
    assert found == {(i, j, int(every[i, j])) for i, j in zip(*np.where(every <= dc.RADIUS))}


def plain_similarity(one, two):
    def weights(words):
        if len(words) < 5:
            return Counter([tuple(words)] if words else [])
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    a, b = weights(one), weights(two)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_recall_and_precision_against_all_windows(spark):
    rng = random.Random(5)
    word = lambda: f"w{min(int(rng.expovariate(0.02)), 900)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 15, 22, 40, 60, 140])))) for i in range(30)]
    docs = []
    for n in range(250):
        words = [word() for _ in range(rng.randrange(150))]
        if n % 2:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randrange(3)):
                passage[rng.randrange(len(passage))] = "changed"
            words[len(words) // 2 : len(words) // 2] = passage[rng.randrange(2) :]
        docs.append((n, " ".join(words).upper() if n % 3 else "\n".join(words)))
    want = set()
    for n, text in docs:
        words = text.lower().split()
        for i, item in items:
            item = item.split()
            size = dc.grid_size(len(item))
            for start in range(len(words) - size + 1):
                if plain_similarity(words[start : start + len(item)], item) >= dc.THRESHOLD:
                    want.add((n, i))
                    break
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    rows = dc.contaminated(docs_df, items_df).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert found <= want
    assert len(found) >= 0.97 * len(want) > 40
    for r in rows:
        words = docs[r.doc_id][1].lower().split()[r.first_word : r.first_word + r.n_words]
        assert abs(plain_similarity(words, dict(items)[r.item_id].split()) - r.similarity) < 1e-9
    kept = {r.doc_id for r in dc.clean(docs_df, items_df).collect()}
    assert kept == {n for n, _ in docs} - {n for n, _ in found}


def test_changed_runs_and_cut_beginnings_against_all_windows():
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(5_000)}" for _ in range(n)]
    items = [(i, words(n)) for i, n in enumerate([9, 13, 21, 28, 38, 47, 60, 73, 100, 125, 150, 300, 420] * 2)]
    texts = []
    for _, item in items * 6:
        n = len(item)
        most = max(1, n // 7 - 3)
        kind = rng.randrange(6)
        run, at = rng.randrange(most + 1), rng.randrange(n)
        passage = list(item)
        if kind == 0:
            passage[at : at + run] = words(len(passage[at : at + run]))
        elif kind == 1:
            passage[at : at + run] = []
        elif kind == 2:
            passage[at:at] = words(run)
        elif kind == 3:
            passage = passage[rng.randrange(n // 4 + 1) :]
        elif kind == 4:
            for _ in range(n // 35 + 1):
                at = rng.randrange(n)
                passage[at : at + 2] = words(len(passage[at : at + 2]))
        else:
            passage = passage[n // 2 :] + passage[: n // 2]
        before, after = rng.choice([(0, 0), (30, 200), (0, 200), (30, 0)])
        texts.append([*words(before), *passage, *words(after)])
    want = {}
    for t, text in enumerate(texts):
        for i, item in items:
            starts = range(len(text) - dc.grid_size(len(item)) + 1) if set(text) & set(item) else ()
            near = [s for s in starts if len(set(item) & set(text[s : s + len(item)])) > len(set(item)) // 2]
            best = max((plain_similarity(text[s : s + len(item)], item) for s in near), default=0)
            if best >= dc.THRESHOLD:
                want[t, i] = best
    index = dc.Index([(i, [w.encode() for w in item]) for i, item in items])
    hits = index.hits([" ".join(text) for text in texts])
    found = {(t, hit[0]): hit[4] for t, one in enumerate(hits) for hit in one}
    assert len(want) > 80
    assert found.keys() == want.keys()
    assert all(abs(found[key] - want[key]) < 1e-9 for key in want)


def test_slices_change_nothing(spark, monkeypatch, small_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    once = sorted(map(tuple, dc.contaminated(small_docs, items).collect()))
    monkeypatch.setattr(dc, "SLICE_ITEMS", 7)
    assert sorted(map(tuple, dc.contaminated(small_docs, items).collect())) == once
    assert once


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame(
        [(1, "the same row twice the same row"), (2, None), (3, ""), (None, "short"), (4, "short"), (5, "Short"), (6, "the same row twice the same row")],
        "item_id long, text string",
    )
    found = dc.contaminated(odd_docs, items)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(4, 4), (7, 1), (7, 1)]
    kept = dc.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 2, 3, 5, 6, 8]
    assert dc.contaminated(odd_docs.limit(0), items).count() == 0
    assert dc.contaminated(odd_docs, items.limit(0)).count() == 0
    assert dc.clean(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_items_without_an_id_and_clashing_columns(spark, odd_docs, monkeypatch):
    """Items are searched with or without an id, in as many slices as their number asks for."""
    monkeypatch.setattr(dc, "SLICE_ITEMS", 2)
    words = [f"w{i}" for i in range(400)]
    phrase = lambda a, n: " ".join(words[a : a + n])
    items = [(None, phrase(0, 30)), (7, phrase(50, 30)), (3, phrase(50, 30).upper()), (9, phrase(100, 40)), (None, None), (5, " "), (None, phrase(0, 30)), (8, phrase(200, 50))]
    items = spark.createDataFrame([(*item, "x") for item in items], "item_id long, text string, doc_id string")
    docs = [(1, f"so {phrase(0, 30)} end"), (2, phrase(45, 40)), (3, phrase(300, 60)), (4, None), (None, phrase(100, 40)), (6, phrase(195, 60))]
    docs = spark.createDataFrame([(*doc, "h", 5) for doc in docs], "doc_id long, text string, _hits string, __hits int")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()}
    assert found == {(1, None), (2, 3), (None, 9), (6, 8)}
    cleaned = dc.clean(docs, items)
    assert cleaned.columns == docs.columns
    assert sorted(tuple(r) for r in cleaned.collect()) == [(3, phrase(300, 60), "h", 5), (4, None, "h", 5)]
    assert sum(len(part) for part in dc.slices(items)) == 4
    assert dc.clean(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert dc.contaminated(docs, items.limit(0)).isEmpty() and dc.contaminated(docs.limit(0), items).isEmpty()
