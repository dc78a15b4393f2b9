"""The entry points over catalog tables, from files to the predictions table."""

import pytest

from checks import fixtures as fx
from lexiloom.config import MULTI_LABEL, SINGLE_LABEL, Dataset
from lexiloom.operators.prepare import label_dimension_of_columns
from lexiloom.plans import dataset as ds
from lexiloom.schemas import MULTI_LABEL_PREDICTIONS, SINGLE_LABEL_PREDICTIONS, Splits
from lexiloom.sources.writers import drop_table

SF = "/root/testdata/sf0.001"


def single(spark):
    examples, labels = fx.lang_examples(spark, SF)
    train, test = (df.select("text", "label") for df in fx.train_test(examples))
    return Dataset("lexi_single", 4, SINGLE_LABEL), Splits(train, test, labels), SINGLE_LABEL_PREDICTIONS


def multi(spark):
    train, test = (df.select("text", "labels") for df in fx.train_test(fx.flag_examples(spark, SF)))
    labels = label_dimension_of_columns(spark, ["quality", "toxic"])
    return Dataset("lexi_multi", 2, MULTI_LABEL), Splits(train, test, labels), MULTI_LABEL_PREDICTIONS


@pytest.mark.parametrize("make", [single, multi])
def test_store_train_predict(spark, tmp_path, make):
    info, splits, schema = make(spark)
    ds.store(splits, info, folder=f"{tmp_path}/tables")
    described = ds.describe(spark, info)
    counts = {r["split"]: r["n_rows"] for r in described["row_counts"].collect()}
    assert counts["labels"] == info.num_labels and counts["train"] == splits.train.count()
    assert described["deciles"].count() == 9 and described["leaked"].first().test_rows == counts["test"]

    models, runs = f"{tmp_path}/models", f"{tmp_path}/runs"
    ds.train_run(spark, info, "small", models, runs, vocabulary_size=1)
    run = ds.train_run(spark, info, "large run/1", models, runs).first()
    assert run.params["dataset"] == info.name and run.metrics["train_rows"] == counts["train"]
    assert run.metrics["f1"] > 0.5 and run.metrics["eval_rows"] == counts["test"]
    best = ds.choose_run(spark, runs, info)
    table = ds.predict_run(spark, info, best, models, path=f"{tmp_path}/predictions")
    assert table.columns == schema.names and table.count() == counts["train"] + counts["test"]
    assert [f.dataType for f in table.schema] == [f.dataType for f in schema]
    for name in (info.train, info.test, info.labels, info.predictions):
        drop_table(spark, name)
    with pytest.raises(ValueError):
        ds.choose_run(spark, runs, Dataset("other", 2, SINGLE_LABEL))
