import random
from collections import Counter, defaultdict

from lexiloom.llm import packing

CAPS = (16, 32, 64)


def item_by_item(histogram, capacities, price):
    """The same rule for single pieces and bins: the tightest open bin, else the length with the least cost per token."""
    left = Counter(histogram)
    bins = []
    for length in sorted(histogram, reverse=True):
        while left[length]:
            fitting = [b for b in bins if b[1] >= length]
            if fitting:
                chosen = min(fitting, key=lambda b: b[1])
            else:
                best = None
                for capacity in capacities:
                    if capacity >= length:
                        room, used = capacity, 0
                        for other in sorted(left, reverse=True):
                            take = min(left[other], room // other)
                            used, room = used + take * other, room - take * other
                        value = price(capacity) / used
                        if best is None or value <= best[0]:
                            best = (value, capacity)
                chosen = [best[1], best[1]]
                bins.append(chosen)
            chosen[1] -= length
            left[length] -= 1
    return Counter(next(c for c in capacities if c >= cap - room) for cap, room in bins)


def test_plan_wastes_no_more_than_single_pieces():
    rng = random.Random(1)
    for _ in range(40):
        histogram = Counter(min(64, int(rng.lognormvariate(2.3, 0.9)) + 1) for _ in range(rng.randrange(1, 400)))
        got = packing.plan(dict(histogram), CAPS)
        placed = Counter()
        for group in got:
            used = sum(length * n for length, n in group.contents)
            assert used <= group.capacity and all(c >= group.capacity for c in CAPS if c >= used)
            for length, n in group.contents:
                placed[length] += n * group.count
        assert placed == histogram
        single = item_by_item(histogram, CAPS, packing.cost)
        cost = lambda sizes: sum(packing.cost(c) * n for c, n in sizes.items())
        grouped = Counter()
        for group in got:
            grouped[group.capacity] += group.count
        assert cost(grouped) <= 1.1 * cost(single) + packing.cost(64)


def test_one_capacity_is_plain_best_fit():
    rng = random.Random(2)
    for _ in range(30):
        histogram = Counter(rng.randrange(1, 65) for _ in range(rng.randrange(1, 300)))
        got = sum(group.count for group in packing.plan(dict(histogram), (64,)))
        assert got == sum(item_by_item(histogram, (64,), packing.cost).values())


def check(rows, texts):
    """Pieces join to their texts, and bins are full from the left without gaps."""
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
        pieces[r.doc_id].append(r)
    for doc_id, own in pieces.items():
        copies = Counter(r.piece for r in own)
        assert len(set(copies.values())) == 1
        parts = {r.piece: (r.start_char, r.end_char) for r in own}
        if doc_id in texts:
            text = texts[doc_id] or ""
            assert "".join(text[slice(*parts[k])] for k in sorted(parts)) == text
    for own in bins.values():
        own.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in own:
            assert r.bin_offset == at and r.bin_capacity == own[0].bin_capacity
            at += r.n_tokens
        assert at <= own[0].bin_capacity
    assert set(bins) == set(range(len(bins)))


def test_documents(spark, small_docs):
    rows = packing.pack(small_docs).collect()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    assert {r.doc_id for r in rows} == set(texts)
    check(rows, texts)


def test_odd_rows(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 2)
    rows = packing.pack(odd_docs, (8, 64)).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    check(rows, texts)
    assert sum(r.n_tokens for r in rows if r.doc_id == 5) == 30_000 + sum(r.doc_id == 5 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert packing.pack(odd_docs.limit(0)).count() == 0
