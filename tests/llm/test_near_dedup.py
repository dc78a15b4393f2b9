import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lexiloom.llm import near_dedup
from lexiloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_sets(rows):
    sets = defaultdict(list)
    for doc_id, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if len(words) >= 5:
            sets[doc_id].append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
        else:
            sets[doc_id].append({tuple(words)} if words else set())
    return sets


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_components(rows):
    """All pairs of documents, without any index."""
    sets = plain_sets(rows)
    ids = sorted(sets)
    edges = [
        (x, y)
        for i, x in enumerate(ids)
        for y in ids[:i]
        if any(a & b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[x] for b in sets[y])
    ]
    return roots(ids, edges)


def family(rng, size, words=60, edits=4):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        yield " ".join(copy)


def test_families_against_all_pairs(spark):
    rng = random.Random(4)
    texts = [t for size in (40, 25, 10, 3, 2) for t in family(rng, size)]
    texts += [t for _ in range(30) for t in family(rng, 1)] + texts[:20] + ["one two", "ONE two", "three"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_components(rows)
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_blocks_of_a_crowded_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 8)
    rng = random.Random(5)
    rows = list(enumerate([*family(rng, 60, edits=5), *family(rng, 20, edits=2)]))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == plain_components(rows)


def test_odd_rows(spark, odd_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [of[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 5, 5, 7, 8]
    assert [of[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 8]
    assert near_dedup.near_duplicates(odd_docs.limit(0)).count() == 0


def test_one_id_with_several_texts(spark):
    rng = random.Random(6)
    a, b = list(family(rng, 2, edits=0))[0], list(family(rng, 1))[0]
    rows = [(1, a), (2, a), (2, b), (3, b), (4, "other words here only once now")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == roots(nodes, [e for e in edges if e[0] != e[1]])
    assert found.groupBy("node").count().where(F.col("count") > 1).isEmpty()
