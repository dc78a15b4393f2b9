import hashlib
import re

import numpy as np

from lexiloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(divmod(int(d) * 2, 10)) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def plain(text):
    spans = [
        f"{kind}:{m.start()}:{m.end()}" for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(kind, m[0])
    ]
    counts = [sum(s.startswith(kind) for s in spans) for kind in PATTERNS]
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest()), spans


TEXTS = [
    None, "", "a@b.co_x@d.ef 1.2.3.4.5.6.7.8 300.1.1.1 a@b a@-.x", "x@y.zz@q.rr +1 (234) 567-8901)) 4111 1111 1111 1111",
    "ü😀 mail: jo.doe@ex-a.org, 001.002.003.004 tel +49 30 1234567. 😀 me [at] foo.org call (0301) 234567 now",
    "@@@ a@ b@c 1.1.1.1.1 + +1 +12 +1234567890123456", 'password = "abcd1234efgh" x', "4111-1111-1111-1112 card 4111-1111-1111-1111",
    "1" * 200 + ".2.3.4 " + "9" * 3000, "a" * 50_000 + " @ " + "b." * 30_000, "1.2.3.999999999999999999999", "\u00041\u0002 5.6.7.8\r\n+44 20 7946 0958",
]


def rows_of(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_base_spans(spark, small_docs):
    docs = small_docs.select("doc_id", "text").union(rows_of(spark).selectExpr("doc_id + 1000000", "text"))
    model = pii.fit(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pii.find(docs, model).collect()
    assert len(found) == len(texts)
    for r in found:
        want, spans = plain(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want, (r, spans)
        every = r.spans.split(",") if r.spans else []
        assert set(spans) <= set(every)
        places = sorted(tuple(map(int, s.split(":")[1:])) for s in every if s not in spans)
        assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))


def test_method_adds_spans_and_leaves_numbers_alone(spark, small_docs):
    model = pii.fit(small_docs.select("doc_id", "text").union(rows_of(spark)))
    texts = {0: "me [at] foo.org", 1: 'token = "ab12cd34ef56"', 2: "version 12 of 2024-01-01, page 17, order 555-1234", 3: "plain words"}
    found = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    assert found == {0: "email:0:15", 1: "secret:0:22", 2: "", 3: ""}


def test_expectation_maximisation_orders_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.6
    votes = np.stack(
        [np.where(rng.random(20_000) < p, np.where(truth, 1, -1), np.where(truth, -1, 1)) for p in (0.95, 0.9, 0.75, 0.6)], axis=1
    )
    patterns, inverse = np.unique(votes, axis=0, return_inverse=True)
    posterior, table, share = pii.reliabilities(patterns, np.bincount(inverse.ravel()).astype(float))
    assert abs(share - 0.6) < 0.05
    right = table[:, 1, 2]
    assert all(x > y for x, y in zip(right, right[1:]))
    assert ((posterior[inverse.ravel()] > 0.5) == truth).mean() > 0.95


def test_mask(spark, odd_docs):
    docs = spark.createDataFrame(
        [(1, "x a@b.co y 4111 1111 1111 1111.", 5, "k"), (2, None, 3, None), (3, "+44 4111 1111 1111 z", 1, "")],
        "doc_id long, text string, n_chars long, kind string",
    )
    model = pii.fit(docs)
    masked = pii.mask(docs, model)
    assert masked.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in masked.collect()} == {
        1: ("x [EMAIL] y [CARD].", 19), 2: (None, 3), 3: ("[PHONE] z", 9),
    }
    assert pii.mask(odd_docs, pii.fit(odd_docs)).count() == odd_docs.count()
    assert pii.find(odd_docs, pii.fit(odd_docs.limit(0))).count() == odd_docs.count()
    assert pii.find(odd_docs.limit(0), model).count() == 0


def test_no_python_in_the_plan(small_docs):
    plan = pii.find(small_docs, pii.fit(small_docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_tokens_are_masked_whole(spark, small_docs):
    """Tokens of any length, also with a model that saw few of them."""
    model = pii.fit(small_docs)
    made = {n: "".join("aZ3b9"[i % 5] for i in range(n)) for n in (30, 198, 201, 600, 1000)}
    docs = spark.createDataFrame([(n, f'x token = "{value}" y') for n, value in made.items()], "doc_id long, text string")
    assert {r.text for r in pii.mask(docs, model).collect()} == {"x [SECRET] y"}


def test_columns_of_the_user_stay(spark):
    columns = ["_email", "_ip", "_card", "_phone", "_text", "_base", "_more", "_wide", "_failed", "_judged", "_all", "_apart", "_merged", "_new", "_row", "kind", "n_chars"]
    rows = [(1, "mail a@b.co now", *columns[:-1], 15), (2, None, *[None] * (len(columns) - 1), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in columns[:-1]) + ", n_chars int")
    masked = pii.mask(docs, pii.fit(docs))
    assert masked.columns == docs.columns
    got = {r.doc_id: tuple(r) for r in masked.collect()}
    assert got == {1: (1, "mail [EMAIL] now", *columns[:-1], 16), 2: (2, *[None] * (len(columns) + 1))}
