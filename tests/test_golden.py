"""Small inputs with known results."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexiloom.config import dataset
from lexiloom.functions import vectors as ve
from lexiloom.functions.text import space_length, tokens
from lexiloom.operators import encode as enc
from lexiloom.operators import evaluate as ev
from lexiloom.operators import prepare, profile, runs
from lexiloom.operators.vocabulary import build_vocabulary
from lexiloom.schemas import METRIC_LOG


def one(spark, values, schema, column):
    return spark.createDataFrame([(v,) for v in values], schema).select(column.alias("r")).collect()


def results(spark, values, schema, column):
    return [row["r"] for row in one(spark, values, schema, column)]


def test_space_length(spark):
    texts = ["", "a  b", " a ", "a\nb c", "a\tb", None]
    assert results(spark, texts, "text string", space_length()) == [1, 3, 3, 2, 1, None]


def test_tokens(spark):
    assert results(spark, ["A  b", "", " "], "text string", tokens()) == [["a", "b"], [], []]


def test_decile_grid(spark):
    df = spark.createDataFrame([(i, 1) for i in range(1, 11)], "token_length int, n_rows int")
    rows = profile.histogram_quantiles(df, profile.DECILES).orderBy("probability").collect()
    assert [r.token_length for r in rows] == [1, 2, 4, 4, 5, 6, 8, 8, 9]


@pytest.mark.parametrize("n", [1, 7, 10, 200, 999])
def test_quantiles_equal_exact_approx_quantile(spark, n):
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(50))).cast("int").alias("token_length"))
    got = profile.histogram_quantiles(profile.length_histogram(df), profile.DECILES).orderBy("probability").collect()
    assert [float(r.token_length) for r in got] == df.approxQuantile("token_length", profile.DECILES, 0.0)


def test_quantiles_leave_nulls_out(spark):
    df = spark.createDataFrame([(None, 100), (5, 1), (7, 1)], "token_length int, n_rows int")
    for weight in ("n_rows", None):
        assert profile.histogram_quantiles(df, [0.0, 0.5], weight=weight).select("token_length").distinct().collect() == [(5,)]
    nothing = profile.histogram_quantiles(df.limit(0), [0.5]).first()
    assert nothing.token_length is None


def test_quantiles_of_groups_ignore_weights(spark):
    df = spark.createDataFrame([(1, 100), (2, 1), (3, 1)], "token_length int, n_rows int")
    assert profile.histogram_quantiles(df, [0.5], weight=None).first().token_length == 2
    assert profile.histogram_quantiles(df, [0.5]).first().token_length == 1


def test_top_index(spark):
    rows = results(spark, [[0.1, 0.7, 0.7], [], None], "p array<double>", ve.top_index("p"))
    assert rows == [1, None, None]


def test_two_thresholds(spark):
    p = [0.5, 0.4999, 0.6]
    assert results(spark, [p, [0.1, 0.2]], "p array<double>", ve.indices_above("p")) == [[2], []]
    logits = [0.0, -0.0004, 0.4]
    assert results(spark, [logits], "p array<double>", ve.decisions("p")) == [[1.0, 0.0, 1.0]]


def test_softmax_of_large_scores(spark):
    got = results(spark, [[-41893.0, -41892.0], [1000.0, 1000.0], [], None], "p array<double>", ve.softmax("p"))
    assert got[0] == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)])
    assert got[1] == [0.5, 0.5]
    assert got[2:] == [None, None]


def test_activation_follows_problem_type(spark):
    auto = results(spark, [[0.0, 0.0]], "p array<double>", ve.activation("p", None, "multi_label_classification"))
    assert auto == [[0.5, 0.5]]
    with pytest.raises(ValueError):
        ve.activation("p", "relu")


def test_reject_nan(spark):
    with pytest.raises(PySparkException, match="NaN"):
        results(spark, [[float("nan")]], "p array<double>", ve.reject_nan("p"))


def test_quantize_zero_vector(spark):
    assert results(spark, [[0.0, 0.0]], "p array<double>", ve.dequantize(ve.quantize("p"))) == [[0.0, 0.0]]
    q = results(spark, [[1.0, -0.5]], "p array<double>", ve.quantize("p"))[0]
    assert list(q.steps) == [127, -64] and q.scale == pytest.approx(1 / 127)


def test_flag_packing(spark):
    df = spark.createDataFrame([("1", "t", True, False, None)], "ID string, Tweet string, a boolean, b boolean, c boolean")
    names = prepare.label_columns(df)
    assert names == ["a", "b", "c"]
    assert prepare.multi_label_pack(df, names).first().labels == [1.0, 0.0, 0.0]


def test_null_text_is_rejected(spark):
    df = spark.createDataFrame([(None, 1)], "text string, label int")
    with pytest.raises(PySparkException, match="NOT NULL column text"):
        prepare.single_label_examples(df).collect()


def test_strict_labels(spark):
    labels = prepare.label_dimension_of_columns(spark, ["a", "b", "c", "d"])
    df = spark.createDataFrame([(5,), (0,)], "label long")
    with pytest.raises(PySparkException, match="not in the label table"):
        prepare.attach_label_name(df, labels).collect()
    loose = prepare.attach_label_name(df, labels, strict=False).collect()
    assert sorted((r.label, r.label_name) for r in loose) == [(0, "a"), (5, None)]
    with pytest.raises(PySparkException, match="not in the label table"):
        prepare.label_to_index(spark.createDataFrame([("z",)], "label_name string"), labels).collect()


def test_unknown_dataset():
    assert dataset("banking77").num_labels == 77
    assert dataset("tweet_emotions").predictions == "default.tweet_emotions_predictions"
    with pytest.raises(ValueError):
        dataset("nothing")


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([([-1.0, -1.0], [0.0, 0.0])], "logits array<double>, labels array<float>")
    row = ev.multi_label_metrics(df).first()
    assert (row.f1, row.precision, row.recall) == (0.0, 0.0, 0.0)


def test_single_label_metrics_are_accuracy(spark):
    df = spark.createDataFrame([([0.9, 0.1], 0), ([0.2, 0.8], 0), ([0.5, 0.5], 0)], "logits array<double>, label int")
    row = ev.single_label_metrics(df).first()
    assert row.f1 == row.precision == row.recall == pytest.approx(2 / 3)


def log(spark, values, run="r"):
    rows = []
    for i, f1 in enumerate(values):
        rows += [(run, i + 1.0, "loss", "loss", 0.123456), (run, i + 1.0, "loss", "step", 10.0 * i)]
        rows += [(run, i + 1.0, "eval", "f1", f1), (run, i + 1.0, "eval", "eval_runtime", 3.0)]
        rows += [(run, i + 1.0, "eval", "step", 10.0 * i)]
    return spark.createDataFrame(rows, METRIC_LOG)


def test_early_stop(spark):
    assert runs.early_stop_epoch(log(spark, [0.50, 0.60, 0.604, 0.70])).first().stop_epoch == 3
    assert runs.early_stop_epoch(log(spark, [0.50, 0.60, 0.604, 0.70]), patience=2).first().stop_epoch is None
    assert runs.early_stop_epoch(log(spark, [0.1, 0.2, 0.3])).first().stop_epoch is None


def test_best_epoch(spark):
    rows = runs.best_epoch_metrics(log(spark, [0.5, 0.61237, 0.61237])).collect()
    assert {r.metric: r.value for r in rows} == {
        "loss": 0.123456, "step": 10.0, "f1": 0.6124, "best_model_epoch": 2.0,
    }


def test_best_epoch_needs_both_entries(spark):
    broken = log(spark, [0.5]).where("kind = 'eval'")
    with pytest.raises(PySparkException, match="exactly one"):
        runs.best_epoch_metrics(broken).collect()
    twice = log(spark, [0.5]).unionByName(log(spark, [0.5]))
    with pytest.raises(PySparkException, match="exactly one"):
        runs.best_epoch_metrics(twice).collect()


def test_names_told_twice():
    with pytest.raises(ValueError):
        runs.merged({"a": 1}, {"a": 2})


def test_encode_golden(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, "a z  b"), (4, None)], "doc_id long, text string")
    words = build_vocabulary(spark.createDataFrame([("a a b",)], "text string"), 10)
    got = {r.doc_id: r.input_ids for r in enc.encode(df, words).collect()}
    assert got == {1: [2, 4, 5, 4, 3], 2: [2, 3], 3: [2, 4, 1, 5, 3], 4: None}
    by_key = {r.doc_id: r.input_ids for r in enc.encode(df, words, limit=0).collect()}
    assert by_key == got
    cut = {r.doc_id: r.input_ids for r in enc.encode(df, words, max_length=3).collect()}
    assert cut[1] == [2, 4, 3]
    decoded = {r.doc_id: r.tokens for r in enc.decode(enc.encode(df, words), words).collect()}
    assert decoded[3] == ["[CLS]", "a", "[UNK]", "b", "[SEP]"] and decoded[4] is None
    assert {r.doc_id: r.tokens for r in enc.decode(enc.encode(df, words), words, limit=0).collect()} == decoded
    with pytest.raises(ValueError):
        enc.encode(df, words, max_length=1)


def test_padding_golden(spark):
    df = spark.createDataFrame([(1, [2, 9, 3]), (2, [2, 3])], "doc_id long, input_ids array<int>")
    row = enc.pad_fixed(df, 5).orderBy("doc_id").collect()[1]
    assert row.input_ids == [2, 3, 0, 0, 0] and row.attention_mask == [1, 1, 0, 0, 0]
    batch = enc.pad_to_longest(df.withColumn("batch", F.lit(0))).orderBy("doc_id").collect()
    assert [len(r.input_ids) for r in batch] == [3, 3]


def test_empty_vocabulary(spark):
    df = spark.createDataFrame([], "text string")
    assert [r.id for r in build_vocabulary(df, 5).orderBy("id").collect()] == [0, 1, 2, 3]


def test_vocabulary_ties_at_the_edge(spark):
    df = spark.createDataFrame([("d c b a a",)], "text string")
    rows = build_vocabulary(df, 3).where("not is_special").orderBy("id").collect()
    assert [(r.token, r.id) for r in rows] == [("a", 4), ("b", 5), ("c", 6)]


def test_leaked_rows(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "text string")
    test = spark.createDataFrame([("a",), ("a",), ("c",)], "text string")
    row = profile.leaked_rows(train, test).first()
    assert (row.test_rows, row.leaked_rows) == (3, 2)


def test_best_run_ties(spark):
    df = spark.createDataFrame([("d", "r2", 0.5), ("d", "r1", 0.5), ("e", "r3", None)], "dataset string, run_id string, f1 double")
    assert [tuple(r) for r in runs.best_run(df).collect()] == [("d", "r1", 0.5)]
