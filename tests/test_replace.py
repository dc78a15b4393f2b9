"""Replacing tables, and runs that are measured by their own writes."""

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import runs as rn
from lexiloom.sources.writers import drop_table, replace_table, save_table


def rows(spark, name):
    spark.catalog.refreshTable(name)
    return sorted(tuple(r) for r in spark.table(name).collect())


@pytest.fixture
def name(spark):
    name = "lexi_replaced"
    drop_table(spark, name)
    yield name
    drop_table(spark, name)


@pytest.mark.parametrize("with_path", [False, True])
def test_a_failing_job_leaves_the_old_table(spark, name, tmp_path, with_path):
    path = (lambda n: f"{tmp_path}/{n}") if with_path else lambda n: None
    save_table(spark.range(3), name, path=path("a"))
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("x"))
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception, match="no"):
        replace_table(broken, name, path=path("b"))
    assert rows(spark, name) == [(0,), (1,), (2,)]
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("with_path", [False, True])
def test_a_table_is_replaced_from_itself_with_another_schema(spark, name, tmp_path, with_path):
    path = f"{tmp_path}/same" if with_path else None
    save_table(spark.range(4), name, path=path)
    replace_table(spark.table(name).where("id > 1").selectExpr("id * 10 as ten", "'t' as t"), name, path=path)
    assert rows(spark, name) == [(20, "t"), (30, "t")]
    assert spark.table(name).columns == ["ten", "t"]
    replace_table(spark.table(name).select("t", "ten"), name, path=path, partition_by=["t"])
    assert [r.ten for r in spark.table(name).where("t = 't'").orderBy("ten").collect()] == [20, 30]


def test_replacing_what_is_not_there(spark, name):
    replace_table(spark.range(2), name)
    assert rows(spark, name) == [(0,), (1,)]


def test_a_write_tells_about_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    seen, seconds = rn.observed_write(spark.range(100).repartition(7), path, n=F.count(F.lit(1)), top=F.max("id"))
    assert seen == {"n": 100, "top": 99} and seconds > 0 and spark.read.parquet(path).count() == 100
    seen, _ = rn.observed_write(spark.range(0), path, n=F.count(F.lit(1)), top=F.max("id"))
    assert seen["n"] == 0 and seen["top"] is None


def test_metrics_are_told_apart(spark):
    run = rn.run_row(spark, "a", {}, {"f1": 0.5, "train_minutes": 1, "eval_rows": 3, "model_size_mb": 2, "eval_steps_per_second": 4})
    names = lambda measured: {r.metric for r in rn.run_metrics(run, measured).collect()}
    assert names(False) == {"f1", "eval_rows"}
    assert names(True) == {"train_minutes", "model_size_mb", "eval_steps_per_second"}
    assert names(None) == names(False) | names(True)
