"""Results that must not depend on the size of a side table, and errors instead of silent losses."""

import pytest
from pyspark.sql import functions as F

from lexiloom.config import SINGLE_LABEL, Dataset
from lexiloom.operators import runs as rn
from lexiloom.operators.decode import index_names
from lexiloom.operators.encode import decode, encode
from lexiloom.operators.score import batch_score
from lexiloom.operators.train import train_multi_label, train_single_label
from lexiloom.operators.vocabulary import build_vocabulary
from lexiloom.sources.models import load_model, save_model
from lexiloom.sources.readers import load_splits, table_files


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(1, "a b a", 0), (2, "b c", 1), (3, "", 1), (4, None, 0), (5, "z z z", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, label long")


def by_id(df, column):
    return {r["doc_id"]: r[column] for r in df.collect()}


@pytest.mark.parametrize("key", ["doc_id", None])
def test_scores(spark, examples, key):
    model = train_single_label(examples, 2)
    small = by_id(batch_score(examples, model), "probabilities")
    assert small[4] is None and small[3] is not None
    assert by_id(batch_score(examples, model, key=key, limit=0), "probabilities") == small


def test_tokens_of_ids(spark):
    vocabulary = spark.createDataFrame([(0, "[PAD]"), (7, "x"), (300, "y")], "id int, token string")
    rows = spark.createDataFrame([(1, [7, 300, 0, 5]), (2, []), (3, None)], "doc_id long, input_ids array<int>")
    want = {1: ["x", "y", "[PAD]", None], 2: [], 3: None}
    assert by_id(decode(rows, vocabulary), "tokens") == want
    assert by_id(decode(rows, vocabulary, limit=0), "tokens") == want


def test_ids_and_tokens_without_a_key(spark):
    """Rows that repeat an id, and rows without one, keep their own tokens at every size of the vocabulary."""
    rows = spark.createDataFrame([(1, "a b", "x"), (1, "c", "y"), (None, "b", "z"), (None, None, "n"), (1, "a b", "x")], "doc_id long, text string, _row_key string")
    vocabulary = build_vocabulary(rows, None)
    for df in (rows, rows.select("text"), rows.select("text", "_row_key")):
        small = encode(df, vocabulary)
        large = encode(df, vocabulary, limit=0)
        assert large.columns == small.columns == [*df.columns, "input_ids"]
        assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
        both = [decode(small, vocabulary, limit=limit) for limit in (1 << 26, 0)]
        assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
        assert [r.tokens for r in both[0].collect() if r.text == "c"] == [["[CLS]", "c", "[SEP]"]]


@pytest.mark.parametrize("key", ["doc_id", None])
def test_names_of_gapped_indices(spark, key):
    labels = spark.createDataFrame([(0, "x"), (5, "y")], "idx int, label string")
    rows = spark.createDataFrame([(1, [5, 0]), (2, []), (3, None)], "doc_id long, at array<int>")
    want = {1: ["y", "x"], 2: [], 3: None}
    assert by_id(index_names(rows, labels, "at", "names"), "names") == want
    assert by_id(index_names(rows, labels, "at", "names", key, limit=0), "names") == want
    wrong = spark.createDataFrame([(1, [1])], "doc_id long, at array<int>")
    for limit in (0, 1 << 20):
        with pytest.raises(Exception, match="not in the label table"):
            index_names(wrong, labels, "at", "names", "doc_id", limit).collect()


def test_wrong_labels_fail(spark, examples):
    for label in (2, -1, None):
        bad = examples.withColumn("label", F.when(F.col("doc_id") == 2, F.lit(label)).otherwise(F.col("label")))
        with pytest.raises(Exception, match="label is not in"):
            train_single_label(bad, 2)
    lists = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0])], "text string, labels array<float>")
    with pytest.raises(Exception, match="labels must have 2 values"):
        train_multi_label(lists, 2)


def test_all_tokens_without_a_size(spark, examples):
    assert train_single_label(examples, 2).weights.count() == 4 + 1
    every, two = build_vocabulary(examples, None), build_vocabulary(examples, 2)
    assert [r.token for r in every.orderBy("id").collect()][4:] == ["z", "a", "b", "c"]
    assert [r.token for r in two.orderBy("id").collect()][4:] == ["z", "a"]
    plan = two._jdf.queryExecution().toString() + every._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
    assert encode(examples, every).count() == 5


def test_run_ids_stay_apart(spark, examples, tmp_path):
    ids = ["1", "01", "2024-01-01", "a/b", "a b=%"]
    for n, run_id in enumerate(ids):
        save_model(train_single_label(examples, 2, smoothing=n + 1.0), run_id, str(tmp_path / "models"))
        for f1 in (0.1, n / 10):
            rn.append_run(rn.run_row(spark, run_id, {"dataset": "d"}, {"f1": f1}), str(tmp_path / "runs"))
    scores = set()
    for run_id in ids:
        model = load_model(spark, str(tmp_path / "models"), run_id, SINGLE_LABEL)
        scores.add(tuple(by_id(batch_score(examples, model), "probabilities")[1]))
    assert len(scores) == len(ids)
    with pytest.raises(ValueError, match="no model"):
        load_model(spark, str(tmp_path / "models"), "2", SINGLE_LABEL)
    runs = rn.read_runs(spark, str(tmp_path / "runs")).collect()
    assert {r.run_id: r.metrics["f1"] for r in runs} == {run_id: n / 10 for n, run_id in enumerate(ids)}
    assert len(runs) == len(ids)


def test_files_without_rows_are_listed(spark, tmp_path):
    for name, n in (("a", 3), ("b", 0)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / "t" / name))
    rows = table_files(spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "t"))).collect()
    assert sorted(r.n_rows for r in rows) == [0, 3]


def test_single_label_validation_joins_train(spark, tmp_path):
    for split, n in (("train", 3), ("validation", 2), ("test", 1)):
        spark.range(n).selectExpr("concat('t', id) as text", "0L as label").write.parquet(str(tmp_path / split))
    paths = {split: str(tmp_path / split) for split in ("train", "validation", "test")}
    labels = spark.createDataFrame([(0, "only")], "idx int, label string")
    splits = load_splits(spark, Dataset("d", 1, SINGLE_LABEL), paths, labels)
    assert (splits.train.count(), splits.test.count()) == (5, 1)
    assert [r.label for r in splits.labels.collect()] == ["only"]
