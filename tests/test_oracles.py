"""Every registered query beside its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import difference, open_tables
from lexiloom.schemas import SINGLE_LABEL_PREDICTIONS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, tables, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, tables, sql) is None


def test_entry(spark):
    df = entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SINGLE_LABEL_PREDICTIONS]
    rows = df.collect()
    assert len(rows) == 200
    held_out = [r for r in rows if r.is_train == 0]
    assert sum(r.predicted_label == r.label for r in held_out) / len(held_out) > 0.8


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
