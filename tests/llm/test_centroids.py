"""Dimension-sharded clustering against SQL over the same rows and a plain version in Python integers."""

import hashlib
import random

import duckdb
import pytest

from lexiloom.llm import centroids

SMALL = "/root/testdata/sf0.001"


def plain(rows, k, rounds, scale):
    """Lloyd's rounds in Python integers; ``rows``: (vec_id, components)."""
    vectors = [[int(scale * x // 1) for x in v] for _, v in rows]
    named = [i for i, (vec_id, _) in enumerate(rows) if vec_id is not None]
    first = sorted(named, key=lambda i: (hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), rows[i][1]))[:k]
    points = [list(vectors[i]) for i in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, point)), c) for c, point in enumerate(points))

    for _ in range(rounds):
        labels = [nearest(v)[1] for v in vectors]
        for c in range(len(points)):
            members = [v for v, label in zip(vectors, labels) if label == c]
            if members:
                points[c] = [sum(column) // len(members) for column in zip(*members)]
    found = [nearest(v) for v in vectors]
    total = sum(d for d, _ in found)
    return [
        (vec_id, c, d, sum(x for x, y in found if y == c), total, hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
        for (vec_id, _), (d, c) in zip(rows, found)
    ]


def test_equals_sql(spark):
    got = centroids.cluster(spark.read.parquet(f"{SMALL}/embeddings.parquet")).collect()
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SMALL}/embeddings.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.execute(centroids.ORACLE).fetchall())


@pytest.mark.parametrize("width,pack_rows", [(2, 3), (5, 100), (3, 1)])
def test_equals_plain_version(spark, width, pack_rows):
    """Ties (few distinct values), repeated rows, rows without an id, a centroid that stays empty, blocks that don't divide."""
    values = random.Random(width)
    rows = [(i if i % 11 else None, [values.randint(-2, 2) / 2 for _ in range(5)]) for i in range(60)]
    rows += [(1, [0.25, -0.25, 0.0, 1.0, 2.0]), (1, [0.25, -0.25, 0.0, 1.0, 2.0]), (2, rows[2][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = centroids.cluster(df, k=7, rounds=3, dimensions=5, scale=3, width=width, pack_rows=pack_rows).collect()
    key = lambda row: tuple(-1 if x is None else x for x in row)
    assert sorted(map(key, got)) == sorted(map(key, plain(rows, 7, 3, 3)))


def test_unusable_rows_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, inf]), (8, [1.0, -inf]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, 5, "x", None) for r in rows], "vec_id long, embedding array<float>, cluster int, pack string, distance long")
    got = centroids.cluster(df, dimensions=2, width=1).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in got] == [(1, 0, 0, 0)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got = centroids.cluster(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and got.isEmpty()


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster(df, dimensions=2).collect()
