"""Readers, writers, model and run tables, plug-in models and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.config import MULTI_LABEL, SINGLE_LABEL, Dataset
from lexiloom.functions.vectors import activation, round_scores
from lexiloom.operators import decode as dec
from lexiloom.operators import runs as rn
from lexiloom.operators.linear import score_linear, train_linear, train_linear_grid
from lexiloom.operators.prepare import label_dimension_of_columns
from lexiloom.operators.score import batch_score, batch_score_with
from lexiloom.operators.staging import fresh_path
from lexiloom.operators.train import train_multi_label, train_single_label
from lexiloom.plans import multi_label, single_label
from lexiloom.schemas import MULTI_LABEL_PREDICTIONS, SINGLE_LABEL_EXAMPLES, SINGLE_LABEL_PREDICTIONS, Splits
from lexiloom.sources import models, readers, writers
from lexiloom.streaming import score as stream

SF = "/root/testdata/sf0.001"


def kinds(df):
    return [(f.name, f.dataType) for f in df.schema]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_single_label_splits(spark, tmp_path, fmt):
    rows = spark.createDataFrame([("good film", 1), ("bad film", 0)], "text string, label long")
    for split in ("train", "test"):
        rows.write.format(fmt).save(f"{tmp_path}/{split}")
    paths = {s: f"{tmp_path}/{s}" for s in ("train", "test")}
    splits = readers.load_splits(
        spark, "imdb", paths, ["neg", "pos"], fmt, schema=None if fmt in ("parquet", "orc") else SINGLE_LABEL_EXAMPLES
    )
    assert sorted(tuple(r) for r in splits.train.collect()) == [("bad film", 0), ("good film", 1)]
    assert [tuple(r) for r in splits.labels.orderBy("idx").collect()] == [(0, "neg"), (1, "pos")]
    if fmt == "json":
        with pytest.raises(ValueError, match="schema"):
            readers.load_splits(spark, "imdb", paths, ["neg", "pos"], fmt)


def test_multi_label_splits(spark, tmp_path):
    def save(name, rows):
        spark.createDataFrame(rows, "ID string, Tweet string, anger boolean, joy boolean").write.parquet(f"{tmp_path}/{name}")

    save("train", [("1", "a", True, None)])
    save("validation", [("2", "b", False, True)])
    save("test", [("3", "c", True, True)])
    paths = {s: f"{tmp_path}/{s}" for s in ("train", "validation", "test")}
    splits = readers.load_splits(spark, "tweet_emotions", paths)
    assert sorted((r.text, r.labels) for r in splits.train.collect()) == [("a", [1.0, 0.0]), ("b", [0.0, 1.0])]
    assert [r.label for r in splits.labels.orderBy("idx").collect()] == ["anger", "joy"]
    with pytest.raises(ValueError):
        readers.load_splits(spark, "tweet_emotions", {"train": paths["train"]})


def test_tables(spark, tmp_path):
    df = spark.range(10).withColumn("is_train", F.col("id") % 2)
    writers.save_table(df, "lexiloom_t", path=f"{tmp_path}/a", partition_by=["is_train"])
    assert readers.read_table(spark, "lexiloom_t").count() == 10
    writers.replace_table(df.select(F.col("id").alias("other")), "lexiloom_t", path=f"{tmp_path}/b")
    assert readers.read_table(spark, "lexiloom_t").columns == ["other"]
    files = readers.table_files(readers.read_table(spark, f"{tmp_path}/b"))
    listed = readers.file_list(readers.read_table(spark, f"{tmp_path}/b"))
    assert sorted(r.file_path for r in files.where("n_rows > 0").collect()) <= listed
    assert files.agg(F.sum("n_rows")).first()[0] == 10
    assert all(f.startswith(f"{tmp_path}/b/") for f in listed)
    writers.drop_table(spark, "lexiloom_t")
    assert not spark.catalog.tableExists("lexiloom_t")


def test_paths_lose_their_scheme():
    assert readers.without_scheme("file:///a/b") == "/a/b"
    assert readers.without_scheme("s3a://b/c") == "/b/c"
    assert readers.without_scheme("/a/b") == "/a/b"


def test_row_key(spark):
    path = f"{SF}/documents.parquet"
    first = {r.doc_id: r.row_key for r in readers.with_row_key(spark.read.parquet(path)).select("doc_id", "row_key").collect()}
    second = {r.doc_id: r.row_key for r in readers.with_row_key(spark.read.parquet(path)).select("doc_id", "row_key").collect()}
    assert first == second and len(set(first.values())) == 200


def test_models_of_runs(spark, tmp_path):
    df = spark.createDataFrame([("a b", 0), ("c d", 1)], "text string, label long")
    model = train_single_label(df, 2, 10)
    models.save_model(model, "r1", f"{tmp_path}/m")
    models.save_model(train_single_label(df, 2, 10, smoothing=0.1), "r2", f"{tmp_path}/m")
    again = models.load_model(spark, f"{tmp_path}/m", "r1", SINGLE_LABEL)
    assert again.outputs == 2

    def scores(m):
        return sorted((r.text, r.probabilities) for r in batch_score(df, m).collect())

    assert scores(again) == scores(model)
    with pytest.raises(ValueError):
        models.load_model(spark, f"{tmp_path}/m", "r3", SINGLE_LABEL)


def test_runs_table(spark, tmp_path):
    for run, f1 in (("r1", 0.5), ("r2", 0.7)):
        rn.append_run(rn.run_row(spark, run, {"dataset": "d", "seed": 123}, {"f1": f1}), f"{tmp_path}/runs")
    table = spark.read.parquet(f"{tmp_path}/runs")
    flat = table.select("run_id", F.col("params.dataset").alias("dataset"), F.col("metrics.f1").alias("f1"))
    assert rn.best_run(flat).first().run_id == "r2"
    assert rn.run_metrics(table).count() == 2
    assert rn.rates("train", 60.0, 640, 64, 2) == {
        "train_minutes": 1.0, "train_samples_per_second": 21.3, "train_steps_per_second": 0.33, "train_rows": 640.0,
    }


def length_model():
    """Stands for a model file: the longer the text, the more label 1."""

    def load():
        def predict(texts):
            lengths = np.array([len(t) for t in texts], dtype=float)
            return np.stack([np.zeros(len(texts)), lengths / 1000 - 1], axis=1)

        return predict

    return load


def broken_model():
    def load():
        return lambda texts: np.zeros((len(texts), 3))

    return load


def test_plug_in_model(spark):
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    scored = batch_score_with(docs, length_model(), 2, batch_size=16, function="softmax")
    labels = label_dimension_of_columns(spark, ["short", "long"])
    named = dec.predicted_label(dec.predicted_label_index(scored), labels)
    rows = named.collect()
    assert len(rows) == 200
    assert all((len(r.text) > 1000) == (r.predicted_label == "long") for r in rows if abs(len(r.text) - 1000) > 1)
    with pytest.raises(TypeError):
        batch_score_with(docs, length_model(), 2, text="doc_id")
    with pytest.raises(Exception, match="expected"):
        batch_score_with(docs, broken_model(), 2).collect()


def test_linear_model(spark):
    examples, _ = fx.lang_examples(spark, SF)
    train, test = fx.train_test(examples)
    fitted = train_linear_grid(train, [0.01, 0.1], features=1024, max_epochs=5)
    assert set(fitted) == {0.01, 0.1}
    rows = dec.predicted_label_index(score_linear(test, fitted[0.01])).collect()
    assert len(rows) == test.count()
    assert sum(r.predicted_label_indx == r.label for r in rows) / len(rows) > 0.7
    assert train_linear(train, features=64, max_epochs=1).stages[-1].numClasses == 4


def test_flows_without_a_key(spark):
    examples, labels = fx.lang_examples(spark, SF)
    train, test = (df.select("text", "label") for df in fx.train_test(examples))
    table = single_label.train_and_predict(Splits(train, test, labels), 4, 2000)
    assert kinds(table) == kinds(spark.createDataFrame([], SINGLE_LABEL_PREDICTIONS)) and table.count() == 200

    flags = fx.flag_examples(spark, SF)
    train, test = (df.select("text", "labels") for df in fx.train_test(flags))
    names = label_dimension_of_columns(spark, ["quality", "toxic"])
    table = multi_label.train_and_predict(Splits(train, test, names), 2, 2000)
    assert kinds(table) == kinds(spark.createDataFrame([], MULTI_LABEL_PREDICTIONS)) and table.count() == flags.count()


def test_multi_label_slot_without_positives(spark):
    df = spark.createDataFrame([("a b", [1.0, 0.0]), ("c", [0.0, 0.0])], "text string, labels array<float>")
    row = batch_score(df, train_multi_label(df, 2, 10)).where("text = 'a b'").first()
    assert row.probabilities[0] > 0.5 > row.probabilities[1]


def test_stream_equals_batch(spark, tmp_path):
    """Stateless steps, the plug-in model and the in-place native model give the same rows on a stream."""
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    docs.repartition(4).write.parquet(f"{tmp_path}/in")
    model = train_single_label(docs.withColumn("label", F.col("doc_id") % 2), 2, 500)
    labels = label_dimension_of_columns(spark, ["even", "odd"])

    def steps(df):
        scored = batch_score_with(batch_score(df, model).withColumnRenamed("probabilities", "native"),
                                  length_model(), 2, function="softmax")
        return dec.predicted_label(dec.predicted_label_index(scored), labels)

    source = stream.read_stream(spark, f"{tmp_path}/in", docs.schema, max_files=1)
    query = stream.write_available(steps(source), f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination(120)
    assert query.exception() is None
    got, want = spark.read.parquet(f"{tmp_path}/out"), steps(docs)
    assert got.count() == 200 and got.exceptAll(want.select(*got.columns)).count() == 0


def test_stream_of_batches(spark, tmp_path):
    logits = fx.logits(spark, SF)
    logits.repartition(3).write.parquet(f"{tmp_path}/in")
    source = stream.read_stream(spark, f"{tmp_path}/in", logits.schema, max_files=2)

    def decoded(df):
        return dec.predicted_label_index(
            df.select("vec_id", round_scores(activation("logits", "softmax")).alias("probabilities"))
        )

    query = stream.each_batch_available(source, decoded, f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination(120)
    assert query.exception() is None
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch_id")
    assert got.count() == 500 and got.exceptAll(decoded(logits)).count() == 0


def test_dataset_of_ones_own(spark):
    own = Dataset("news", 5, MULTI_LABEL, "db")
    assert (own.train, own.labels) == ("db.news_train", "db.news_labels")


def test_stored_size(spark):
    path = fresh_path(spark, "size")
    spark.range(200_000).select(F.xxhash64("id").alias("h")).write.parquet(path)
    assert rn.stored_mb(spark, path) >= 1.0
