"""Properties over generated rows; the rows of one example go through Spark together."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lexiloom.functions import vectors as ve
from lexiloom.functions.text import encoded_length
from lexiloom.operators import encode as enc
from lexiloom.operators import evaluate as ev
from lexiloom.operators import prepare, profile
from lexiloom.operators.vocabulary import build_vocabulary

few = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
words = st.sampled_from(["a", "bb", "ccc", "Dd", "é", "ß", "数据", "x-1", "\n", "\t"])
text = st.lists(st.one_of(words, st.just("")), max_size=12).map(" ".join)
texts = st.lists(text, min_size=1, max_size=25)
vectors = st.lists(st.floats(-30, 30), min_size=3, max_size=3)


def rows_of(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def expected_tokens(value):
    return [t for t in value.lower().split(" ") if t]


@few
@given(values=texts)
def test_decode_undoes_encode(spark, values):
    df = rows_of(spark, values)
    vocabulary = build_vocabulary(df, 1000)
    back = enc.decode(enc.encode(df, vocabulary, max_length=None), vocabulary)
    for row in back.collect():
        assert row.tokens == ["[CLS]", *expected_tokens(row.text), "[SEP]"]


@few
@given(values=texts, size=st.integers(2, 9))
def test_masks_and_lengths(spark, values, size):
    df = rows_of(spark, values)
    padded = enc.pad_fixed(enc.encode(df, build_vocabulary(df, 3), max_length=size), size)
    for row in padded.collect():
        assert len(row.input_ids) == len(row.attention_mask) == size
        assert sum(row.attention_mask) == min(len(expected_tokens(row.text)) + 2, size)
        assert all(i == 0 for i, m in zip(row.input_ids, row.attention_mask) if m == 0)


@few
@given(values=texts, batch=st.integers(1, 7))
def test_batches(spark, values, batch):
    df = rows_of(spark, values)
    encoded = enc.encode(df, build_vocabulary(df, 50)).withColumn("encoded_length", encoded_length("text"))
    assert encoded.where(F.size("input_ids") != F.col("encoded_length")).count() == 0
    batched = enc.group_by_length(encoded.withColumn("n", F.size("input_ids")), batch, "n", "doc_id")
    rows = enc.pad_to_longest(batched).orderBy("idx").collect()
    assert [r.n for r in rows] == sorted(r.n for r in rows)
    for start in range(0, len(rows), batch):
        group = rows[start:start + batch]
        assert {r.batch for r in group} == {start // batch}
        assert {len(r.input_ids) for r in group} == {max(r.n for r in group)}
    cost = {r.strategy: r for r in enc.padding_cost(encoded, batch, "doc_id", max_length=16).collect()}
    real = sum(r.n for r in rows)
    assert all(r.real == real for r in cost.values())
    assert real <= cost["by_length"].padded <= cost["dynamic"].padded <= cost["fixed"].padded


@few
@given(values=texts)
def test_histogram_counts_every_row(spark, values):
    histogram = profile.token_length_histogram(rows_of(spark, values)).collect()
    assert sum(r.n_rows for r in histogram) == len(values)
    assert [r.token_length for r in histogram] == sorted({len(v.split(" ")) for v in values})


@few
@given(a=texts, b=texts)
def test_union_keeps_every_row(spark, a, b):
    both = prepare.union_train_test(rows_of(spark, a), rows_of(spark, b))
    assert sorted(r.text for r in prepare.split_filter(both, True).collect()) == sorted(a)
    assert sorted(r.text for r in prepare.split_filter(both, False).collect()) == sorted(b)


@few
@given(values=st.lists(st.tuples(vectors, st.integers(0, 2)), min_size=1, max_size=20))
def test_micro_metrics_of_single_labels_are_equal(spark, values):
    df = spark.createDataFrame(values, "logits array<double>, label int")
    row = ev.single_label_metrics(df).first()
    accuracy = sum(v.index(max(v)) == y for v, y in values) / len(values)
    assert row.f1 == row.precision == row.recall and abs(row.f1 - accuracy) < 1e-12


@few
@given(values=st.lists(vectors, min_size=1, max_size=20))
def test_probabilities_and_steps(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v array<double>")
    for row in df.select("v", ve.softmax("v").alias("p"), ve.dequantize(ve.quantize("v")).alias("d")).collect():
        assert abs(sum(row.p) - 1) < 1e-9
        half = max(abs(x) for x in row.v) / 127 / 2
        assert all(abs(x - y) <= half * (1 + 1e-9) for x, y in zip(row.v, row.d))
