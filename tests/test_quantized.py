"""Quantized models: steps, scores, comparison and stored sizes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.config import MULTI_LABEL, SINGLE_LABEL
from lexiloom.operators import quantized as qt, score as sc
from lexiloom.operators.evaluate import metrics_for
from lexiloom.operators.score import add_logits
from lexiloom.operators.staging import free_name
from lexiloom.operators.train import BIAS_ID, train_multi_label, train_single_label
from lexiloom.sources import models as md

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    examples, _ = fx.lang_examples(spark, SF)
    train, test = fx.train_test(examples)
    return train, test, train_single_label(train, 4)


def test_steps_against_numpy(trained):
    _, _, model = trained
    full = {r.id: r.weights for r in model.weights.collect()}
    bias = full.pop(BIAS_ID)
    packed = qt.quantize_model(model)
    scales = packed.scales.first()
    weights = np.array(list(full.values()))
    assert scales.scales == pytest.approx((np.abs(weights).max(axis=0) / 127).tolist(), rel=1e-15) and scales.bias == bias
    found = {r.id: r.steps for r in packed.steps.collect()}
    want = np.rint(weights / np.array(scales.scales)).astype(int)
    assert [found[i] for i in full] == want.tolist() and np.abs(want).max() == 127
    assert packed.steps.schema["steps"].dataType.simpleString() == "array<tinyint>"


def test_weights_of_zero_have_scale_one(spark):
    rows = [(BIAS_ID, None, [0.5, 1.0]), (4, "a", [0.0, -2.0]), (5, "b", [0.0, 1.0])]
    model = qt.quantize_model(qt.Model(spark.createDataFrame(rows, "id int, token string, weights array<double>"), 2, SINGLE_LABEL))
    assert model.scales.first().scales == [1.0, 2.0 / 127]
    assert {r.token: r.steps for r in model.steps.collect()} == {"a": [0, -127], "b": [0, 64]}
    texts = spark.createDataFrame([(1, "a a b x"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.logits for r in qt.add_quantized_logits(texts, model).collect()}
    assert got == {1: [0.5, 1.0 - 190 * (2.0 / 127)], 2: [0.5, 1.0], 3: None}


@pytest.mark.parametrize("key", ["doc_id", None])
def test_scores_are_the_same_both_ways(spark, trained, key):
    _, test, model = trained
    odd = spark.createDataFrame([(-1, "", 0, "test"), (-2, "zzzzqqqq", 0, "test"), (-3, None, 0, "test")], "doc_id long, text string, label long, split string")
    rows = test.unionByName(odd.select(test.columns)).withColumn("_row_key", F.lit("mine"))
    packed = qt.quantize_model(model)
    small = qt.add_both_logits(rows, model, packed).collect()
    large = qt.add_both_logits(rows, model, packed, key=key, limit=0).collect()
    assert {r._row_key for r in large} == {"mine"}
    a, b = ({r.doc_id: (r.logits, r.quantized_logits) for r in found} for found in (small, large))
    assert a.keys() == b.keys() and a.pop(-3) == b.pop(-3) == (None, None)
    for i in a:
        assert a[i][0] == pytest.approx(b[i][0], rel=1e-12) and a[i][1] == b[i][1]
    alone = {r.doc_id: r.logits for r in qt.add_quantized_logits(rows, packed).collect()}
    assert all(alone[i] == a[i][1] for i in a)
    full = {r.doc_id: r.logits for r in add_logits(rows, model).collect()}
    assert all(full[i] == pytest.approx(a[i][0], rel=1e-12) for i in a)
    by_weights = {r.doc_id: r.logits for r in add_logits(rows, qt.dequantize_model(packed)).collect()}
    assert all(by_weights[i] == pytest.approx(a[i][1], rel=1e-9) for i in a)


@pytest.mark.parametrize("limit", [1 << 26, 8_000])
@pytest.mark.parametrize("key", ["doc_id", None])
def test_tokens_meet_a_large_model_as_compiled_rows(spark, monkeypatch, key, limit):
    texts = ["w1 w2 w2 W3", "w299 w299 w1", "nothing known", "", " ", None, "w150 w298 x w0"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights = [(BIAS_ID, None, [0.5, -1.0])] + [(4 + i, f"w{i}", [float(i), 127.0 - i]) for i in range(300)]
    model = qt.Model(spark.createDataFrame(weights, "id int, token string, weights array<double>"), 2, SINGLE_LABEL)
    packed = qt.quantize_model(model)
    small = {r.doc_id: r.logits for r in qt.add_quantized_logits(df, packed).collect()}
    monkeypatch.setattr(sc, "IN_PLACE_BYTES", 4_000, raising=False)
    large = qt.add_quantized_logits(df, packed, key=key, limit=limit)
    assert large.columns == ["doc_id", "text", "logits"]
    assert {r.doc_id: r.logits for r in large.collect()} == small and len(small) == len(texts) and small[5] is None
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(array_remove(split(lower(text" in plan and "BroadcastHashJoin" in plan
    # No table in the tasks, and no interpreted lookup of each token.
    assert "xxhash64" not in plan and "collect_list" not in plan


@pytest.mark.parametrize("problem", [SINGLE_LABEL, MULTI_LABEL])
def test_comparison_equals_separate_metrics(spark, problem):
    if problem == MULTI_LABEL:
        train, test = fx.train_test(fx.flag_examples(spark, SF).withColumn("split", F.lit("")))
        model = train_multi_label(train, 2)
    else:
        train, test = fx.train_test(fx.lang_examples(spark, SF)[0])
        model = train_single_label(train, 4)
    packed = qt.quantize_model(model)
    got = {r.model: r for r in qt.compare_with_quantized(test, model, packed).collect()}
    scored = qt.add_both_logits(test, model, packed)
    for name, column in (("full", "logits"), ("quantized", "quantized_logits")):
        want = metrics_for(scored, problem, scores=column).first()
        assert (got[name].f1, got[name].precision, got[name].recall) == (want.f1, want.precision, want.recall)
        assert got[name].n_rows == test.count() and 0 < got[name].same <= got[name].n_rows
    nothing = qt.compare_with_quantized(test.limit(0), model, packed).collect()
    assert [(r.f1, r.same, r.n_rows) for r in nothing] == [(0.0, 0, 0)] * 2


def test_texts_are_read_once_and_not_shuffled(spark, trained):
    _, _, model = trained
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    plan = qt.add_both_logits(docs, model, qt.quantize_model(model))._jdf.queryExecution().executedPlan().toString()
    # Lines of subqueries hang on a colon.
    main = [line for line in plan.splitlines() if ":" not in line.split("+-")[0] and "Subquery" not in line.split("[")[0]]
    assert not any("Exchange" in line or "Join" in line for line in main)
    assert sum(line.count("split(lower(text") for line in main) == 1 and "Python" not in plan


def test_sizes_are_those_of_the_files(spark, trained, tmp_path):
    _, test, model = trained
    packed = qt.quantize_model(model)
    folder, run = str(tmp_path / "models"), "a b/c"
    md.save_model(model, "full", folder)
    md.save_quantized(packed, run, folder)

    def on_disk(run_id):
        found = [os.path.join(at, f) for at, _, files in os.walk(md.model_path(folder, run_id)) for f in files if f.endswith(".parquet")]
        return len(found), sum(map(os.path.getsize, found))

    got = {r.run_id: r for r in md.model_sizes(spark, folder, ["full", run]).collect()}
    for run_id in ("full", run):
        assert (got[run_id].files, got[run_id].bytes) == on_disk(run_id)
    assert got["full"].share == 1.0 and got[run].share < 1.0
    again = md.load_quantized(spark, folder, run, SINGLE_LABEL)
    one, two = (qt.batch_score_quantized(test, x).orderBy("doc_id").collect() for x in (packed, again))
    assert one == two
    with pytest.raises(ValueError, match="no quantized model"):
        md.load_quantized(spark, folder, "other", SINGLE_LABEL)


def test_free_name(spark):
    df = spark.createDataFrame([(1, 2)], "_Row_Key int, __row_key int")
    assert free_name(df, "_row_key") == "___row_key" and free_name(df, "x") == "x"
