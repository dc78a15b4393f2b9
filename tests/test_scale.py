"""Skew, large dimensions, stable order and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.operators import encode as enc
from lexiloom.operators import prepare
from lexiloom.operators.lookup import heavy_keys, key_counts, lookup_join
from lexiloom.operators.ordering import dense_index
from lexiloom.operators.score import add_logits
from lexiloom.operators.staging import fits, measure, staging_dir
from lexiloom.operators.train import train_single_label
from lexiloom.operators.token_vectors import first_position_vector, token_vectors
from lexiloom.operators.vocabulary import build_vocabulary, token_counts, likely_tokens

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, rows=60_000):
    """A third of the rows hold one key, some hold none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 20_011).cast("long")
    return spark.range(rows).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_plain_join(spark, how):
    df = skewed(spark)
    dim = spark.range(0, 15_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = df.join(dim, "k", how).select("id", "k", "v")
    for limit in (1 << 30, 20_000, 0):
        got = lookup_join(df, dim, "k", how, limit).select("id", "k", "v")
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_heavy_keys_are_few_and_right(spark):
    df = skewed(spark)
    counts, keyed, blank = key_counts(df, "k")
    assert (keyed, blank) == (40_000, 20_000) and df.where("k IS NULL").count() == 20_000
    assert [r.k for r in heavy_keys(counts, keyed, 10_000).collect()] == [7]
    assert heavy_keys(counts, keyed, 20_000).count() <= 20_000
    counts, keyed, _ = key_counts(df.limit(0), "k")
    assert keyed == 0 and heavy_keys(counts, keyed, 100).count() == 0


def test_measure_counts_strings_and_arrays(spark):
    df = spark.createDataFrame([("abcd", [1.0, 2.0], {"k": "vv"})], "s string, a array<double>, m map<string,string>")
    rows, size = measure(df)
    assert rows == 1 and size >= 32 + 4 + 16 + 3
    assert fits(df, size) and not fits(df, size - 1)
    assert measure(df.limit(0)) == (0, 0)


@pytest.mark.parametrize("partitions", [1, 8, 31])
def test_dense_index_equals_rank(spark, partitions):
    df = skewed(spark, 5_000).select("id", F.col("id") % 2 == 0, F.lit(1).alias("same")).repartition(partitions)
    rows = dense_index(df, ["same", F.desc("id")]).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(5_000))
    assert [r.id for r in rows] == list(range(4_999, -1, -1))


def test_dense_index_of_nothing(spark):
    assert dense_index(spark.range(0), ["id"]).count() == 0


def test_shuffle_rows_is_a_stable_permutation(spark):
    df = spark.range(500)
    a = [r.id for r in prepare.shuffle_rows(df, ["id"], seed=1).collect()]
    b = [r.id for r in prepare.shuffle_rows(df.repartition(5), ["id"], seed=1).collect()]
    c = [r.id for r in prepare.shuffle_rows(df, ["id"], seed=2).collect()]
    assert a == b != c and sorted(a) == sorted(c) == list(range(500)) != a


def test_encode_does_not_shuffle_the_texts(spark):
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    encoded = enc.encode(docs, build_vocabulary(docs, 1000)).select("doc_id", "input_ids")
    text = plan(encoded)
    main = text.split("Subquery")[0]
    # The lookup table stays a subquery of the one projection over the scan; no copy per row.
    assert "Exchange" not in main and "Python" not in text and text.count("_buckets") == 0
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_vocabulary_reads_the_texts_once(spark):
    top = likely_tokens(token_counts(fx.table(spark, SF, "documents").select("text")), 100)
    kept = {r.token: r.n for r in top.collect()}
    assert len(kept) >= 100 and sum(n > min(kept.values()) for n in kept.values()) < 100
    assert "ReusedExchange" in plan(top)


def test_token_vectors_encode_once(spark):
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    vectors = spark.range(600).select(F.col("id").cast("int").alias("id"), F.array(F.lit(1.0)).alias("vector"))
    encoded = enc.encode(docs, build_vocabulary(docs, 500)).select("doc_id", "input_ids")
    for df in (token_vectors(encoded, vectors), first_position_vector(encoded, vectors)):
        # The texts are split in one place of the plan only.
        assert plan(df).count("split(lower(text") == 1 and "BroadcastHashJoin" in plan(df)
    by_shuffle = token_vectors(encoded, vectors, limit=0)
    assert token_vectors(encoded, vectors).exceptAll(by_shuffle).count() == 0
    assert first_position_vector(encoded, vectors, limit=0).where("vector IS NOT NULL").count() == 200


def test_scoring_does_not_shuffle_the_texts(spark):
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    model = train_single_label(docs.withColumn("label", F.col("doc_id") % 2), 2, 1000)
    text = plan(add_logits(docs, model).select("doc_id", "logits"))
    assert text.count("_buckets") == 0 and text.count("_bias") == 0 and "Python" not in text
    assert "Join" not in text


def test_scores_are_the_same_both_ways(spark):
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    empty = spark.createDataFrame([(-1, ""), (-2, "zzzzqqqq"), (-3, None)], "doc_id long, text string")
    model = train_single_label(docs.withColumn("label", F.col("doc_id") % 3), 3, 2000)
    rows = docs.unionByName(empty)
    a = {r.doc_id: r.logits for r in add_logits(rows, model).collect()}
    b = {r.doc_id: r.logits for r in add_logits(rows, model, key="doc_id", limit=0).collect()}
    assert a.keys() == b.keys() and len(a) == 203
    assert a.pop(-3) is None and b.pop(-3) is None
    assert all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)
    c = {r.doc_id: r.logits for r in add_logits(rows, model, limit=0).collect()}
    assert c.pop(-3) is None and all(a[k] == pytest.approx(c[k], rel=1e-12) for k in a)


def test_staging_dir_is_the_named_one(spark):
    assert staging_dir(spark) == spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("key", [None, "doc_id"])
def test_only_rare_tokens_are_joined_above_the_limit(spark, monkeypatch, key):
    from lexiloom.operators import score

    rows = [(i, f"a b a b c a w{i % 40} x{i}") for i in range(200)] + [(900, None), (901, ""), (902, "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = train_single_label(df.where("text is not null").withColumn("label", F.col("doc_id") % 2), 2)
    joined = []

    def counting(pieces, *rest):
        joined.append(pieces.count())
        return lookup_join(pieces, *rest)

    monkeypatch.setattr(score, "lookup_join", counting)
    got = {r.doc_id: r.logits for r in add_logits(df, model, key=key, limit=8_000).collect()}
    assert 0 < joined[0] < 500
    plain = {r.doc_id: r.logits for r in add_logits(df, model).collect()}
    assert got.keys() == plain.keys() and got.pop(900) is None and plain.pop(900) is None
    assert all(got[k] == pytest.approx(plain[k], rel=1e-12) for k in got)


@pytest.mark.parametrize("outputs", [2, 11])
def test_counts_take_their_ids_without_a_join(spark, monkeypatch, outputs):
    from lexiloom.operators import train

    monkeypatch.setattr(train, "lookup_join", None)
    df = spark.createDataFrame([("b a b", 0), ("c", 1), ("a b", 1), (None, 1)], "text string, label long")
    for size, names in ((None, ["b", "a", "c"]), (2, ["b", "a"])):
        found = train.count_single_label(df, outputs, size).tokens.orderBy("id").collect()
        assert [r.token for r in found] == names and [r.n[:2] for r in found] == [[2, 1], [1, 1], [0, 1]][: len(names)]
        assert all(len(r.n) == outputs for r in found)
