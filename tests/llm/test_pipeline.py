import random

import corpus_pipeline
from lexiloom.llm import decontaminate, near_dedup, pii, quality_rules

from .test_near_dedup import plain_components
from .test_packing import check
from .test_pii import plain


def test_stages_against_plain_versions(spark, small_docs, small_labels):
    sf = "/root/testdata/sf0.001"
    docs = small_docs
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = corpus_pipeline.stored(stage(spark, docs, sf), name)
        rows = after.collect()
        if name != "packing":
            assert after.columns == small_docs.columns
        ids = {r.doc_id for r in rows}
        if name == "quality_rules":
            rules = quality_rules.fit(docs, small_labels)
            want = {r.doc_id for r in quality_rules.judge(docs, rules).collect() if r.kept}
            bad = {r.doc_id for r in small_labels.where("quality = 0").collect()}
            good = {r.doc_id for r in small_labels.where("quality = 1").collect()}
            counts = {r.doc_id: quality_rules.counts_of(r.text) for r in before}
            failed = {i for i, c in counts.items() if c[0] < 50 or 100 * c[4] > 50 * c[0]}
            assert ids == want and not ids & failed
            assert len(ids & bad) <= 0.2 * len(bad) and len(ids & good) >= 0.95 * len(good - failed)
        elif name == "near_dedup":
            found = plain_components([(r.doc_id, r.text) for r in before])
            assert ids == set(found.values()) and len(rows) == len(ids)
        elif name == "decontamination":
            items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            texts = {r.doc_id: f" {' '.join((r.text or '').lower().split())} " for r in before}
            holding = {i for i, text in texts.items() if any(f" {item} " in text for item in items)}
            assert not ids & holding and len(set(texts) - holding - ids) <= len(texts) // 50
        elif name == "pii":
            assert ids == {r.doc_id for r in before}
            for r in rows:
                assert not plain(r.text)[1], r.text
                assert r.n_chars == len(r.text)
        else:
            check(rows, {r.doc_id: r.text for r in before})
            assert ids == {r.doc_id for r in before}
        docs = after


def test_odd_rows_pass_all_stages(spark, odd_docs):
    rng = random.Random(1)
    fine = [(100 + n, " ".join(f"w{rng.randrange(900)}" for _ in range(80))) for n in range(5)]
    docs = odd_docs.unionByName(spark.createDataFrame(fine, "doc_id long, text string"), allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs.limit(0), docs):
            out = stage(spark, rows, "/root/testdata/sf0.001")
            assert out.count() == 0 if rows is not docs else True
            if name != "packing":
                assert out.columns == odd_docs.columns
        docs = corpus_pipeline.stored(out, name)
    assert {100, 101, 102, 103, 104} <= {r.doc_id for r in docs.collect()}
    assert {decontaminate, near_dedup, pii}
