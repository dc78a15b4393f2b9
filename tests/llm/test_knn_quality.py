import numpy as np

from lexiloom.llm import knn_quality as knn


def test_votes_against_all_products():
    rng = np.random.default_rng(0)
    counts = np.log1p(rng.poisson(0.3, (200, knn.BINS)).astype(np.float32))
    labels = rng.integers(0, 2, 200)
    space = knn.space_of(counts, labels, 16)
    texts = [None, *np.log1p(rng.poisson(0.3, (20, knn.BINS)).astype(np.float32))]
    got = knn.vote(space, texts)
    assert got[0] == 0.0
    for row, value in zip(texts[1:], got[1:]):
        vector = row * space.weights
        vector = vector / np.linalg.norm(vector) @ space.projection
        cosine = space.vectors @ (vector / np.linalg.norm(vector))
        near = np.argsort(-cosine)[: knn.NEIGHBOURS]
        weight = np.clip(cosine[near], 0, None) ** 4 + 1e-9
        assert abs((weight * labels[near]).sum() / weight.sum() - value) < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = knn.score(docs, knn.fit(docs, labels))
    rows = scored.where("held_out").join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted == 0 for r in rows if r.quality == 0]) > 0.85


def test_held_out_rows_are_never_learned_from(spark, small_docs, small_labels):
    flipped = small_labels.withColumn("quality", knn.F.when(knn.held_out(knn.F.col("doc_id")), 1 - knn.F.col("quality")).otherwise(knn.F.col("quality")))
    one, two = knn.fit(small_docs, small_labels), knn.fit(small_docs, flipped)
    assert (one.vectors == two.vectors).all() and (one.labels == two.labels).all()


def test_odd_rows(spark, odd_docs, small_docs, small_labels):
    space = knn.fit(small_docs, small_labels)
    rows = knn.score(odd_docs, space).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.score == 0.0 and r.predicted == 0 for r in rows if r.doc_id in (1, 2))
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    empty = knn.fit(odd_docs, small_labels.limit(0))
    assert {r.score for r in knn.score(odd_docs, empty).collect()} == {0.0}
    assert knn.score(odd_docs.limit(0), space).count() == 0
