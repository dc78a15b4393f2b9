"""Centroid clustering by Lloyd rounds that are sharded over dimensions, in exact integer arithmetic.

1. Vectors become integers floor(scale * x) and are dealt into packs of bounded size; a pack is cut into blocks of columns.
   The blocks are written once, each row a small matrix, so a vector of any width is never whole in one task.
2. A round sends every block the matching slice of each centroid. The partial squared distances of the blocks of a pack are
   added by its key, and the nearest centroid is the argmin; ties go to the smaller number.
3. The labels go back to the blocks (by broadcast when measured to be small, else by a join). Each task adds up its own
   columns per centroid, so only centroids times columns numbers leave it, and each slice is replaced by floor(sum / count).
   A centroid without vectors stays.

What the driver holds are the centroids: k times the dimension. Packs have equal sizes, so a cluster that holds most
vectors meets in no task. Each round's labels are written to the shared folder; a lost task repeats only its own packs.

Vectors that are null, of another length or with a null or non-finite component are left out. The first centroids are the
vectors with the smallest hashes of their id; equal ids are ordered by their components. Rows that repeat are clustered one
by one; rows without an id are, too, but start no centroid. With fewer vectors than centroids there are fewer centroids; an
empty table gives no row. Components beyond 2^26 after scaling fail the job, as their distances may not fit a long. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lexiloom.llm.common import small, stored

CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
#: Columns of a block and vectors of a pack.
BLOCK_COLUMNS, PACK_ROWS = 16, 4096
LARGEST = 1 << 26

Batches = Iterator[pa.RecordBatch]


def usable(column: str, dimensions: int) -> str:
    """SQL condition: exactly ``dimensions`` components, all finite."""
    finite = f"forall({column}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return f"coalesce(size({column}) = {dimensions} and {finite}, false)"


def _blocks(rows: DataFrame, dimensions: int, scale: int, width: int, pack_rows: int) -> DataFrame:
    """(pack, block, ids, data): the columns of one block of a pack as a matrix of integers; ids come with block 0."""

    def cut(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, pack_rows):
                batch = whole.slice(at, pack_rows)
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                scaled = np.floor(scale * flat).reshape(batch.num_rows, dimensions)
                if np.abs(scaled).max() > LARGEST:
                    raise ValueError(f"a component beyond {LARGEST} after scaling")
                matrix = scaled.astype(np.int32)
                starts = range(0, dimensions, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(starts), pa.int64()),
                        pa.array(range(len(starts)), pa.int32()),
                        pa.array([batch.column(0).to_pylist(), *[None] * (len(starts) - 1)], pa.list_(pa.int64())),
                        pa.array([np.ascontiguousarray(matrix[:, s : s + width]).tobytes() for s in starts], pa.binary()),
                    ],
                    names=["pack", "block", "ids", "data"],
                )
                number += 1

    return rows.mapInArrow(cut, "pack long, block int, ids array<long>, data binary")


def _matrix(data: bytes, dimensions: int, width: int, block: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int32).reshape(-1, min(width, dimensions - block * width)).astype(np.int64)


def _assign(blocks: DataFrame, centroids: np.ndarray, width: int, with_ids: bool = False) -> DataFrame:
    """(pack, ids, labels, distances): the nearest centroid of each vector of a pack, from the sums over its blocks."""
    k, dimensions = centroids.shape

    def partial(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column(1)[i].as_py()
                columns = _matrix(batch.column(3)[i].as_py(), dimensions, width, block)
                piece = centroids[:, block * width : (block + 1) * width]
                distances = np.empty((len(columns), k), dtype=np.int64)
                for c in range(k):
                    distances[:, c] = ((columns - piece[c]) ** 2).sum(axis=1)
                ids = batch.column(2).slice(i, 1) if with_ids else pa.array([None], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), ids, pa.array([distances.tobytes()], pa.binary())],
                    names=["pack", "ids", "data"],
                )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), dtype=np.int64).reshape(-1, k) for x in table["data"])
        ids = next((x for x in table["ids"].to_pylist() if x is not None), None)
        labels = total.argmin(axis=1)
        nearest = total[np.arange(len(total)), labels]
        return pa.table(
            {
                "pack": table["pack"].slice(0, 1),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "labels": pa.array([labels.astype(np.int32)], pa.list_(pa.int32())),
                "distances": pa.array([nearest], pa.list_(pa.int64())),
            }
        )

    parts = blocks.mapInArrow(partial, "pack long, ids array<long>, data binary")
    return parts.groupBy("pack").applyInArrow(add, "pack long, ids array<long>, labels array<int>, distances array<long>")


def _updated(blocks: DataFrame, labels: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Centroids after each block replaced its own slice by the floored means of its columns."""
    k, dimensions = centroids.shape

    def sums(batches: Batches) -> Batches:
        found: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data, given in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                columns, given = _matrix(data, dimensions, width, block), np.array(given)
                total = found.setdefault(block, np.zeros((k, columns.shape[1]), dtype=np.int64))
                number = counts.setdefault(block, np.zeros(k, dtype=np.int64))
                for c in np.unique(given):
                    inside = given == c
                    total[c] += columns[inside].sum(axis=0)
                    number[c] += inside.sum()
        for block, total in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * k, pa.int32()), pa.array(range(k), pa.int32()),
                    pa.array(counts[block], pa.int64()), pa.array(list(total), pa.list_(pa.int64())),
                ],
                names=["block", "cluster", "n", "sums"],
            )

    rows = blocks.select("pack", "block", "data").join(small(labels.select("pack", "labels")), "pack")
    parts = rows.select("block", "data", "labels").mapInArrow(sums, "block int, cluster int, n long, sums array<long>")
    columns = parts.select("block", "cluster", "n", F.posexplode("sums").alias("column", "value"))
    means = columns.groupBy("block", "cluster", "column").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    # The remainder goes first, so that the quotient is floored below zero, too.
    means = means.where("n > 0").selectExpr("block", "cluster", "column", "(value - pmod(value, n)) div n as mean")
    after = centroids.copy()
    for row in means.collect():
        after[row["cluster"], row["block"] * width + row["column"]] = row["mean"]
    return after


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    width: int = BLOCK_COLUMNS,
    pack_rows: int = PACK_ROWS,
    seed: int = 1,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable row of ``vectors``."""
    spark = vectors.sparkSession
    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(usable("embedding", dimensions))
    first = (
        kept.where("vec_id is not null")
        .orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), "embedding")
        .limit(k)
        .select("embedding")
        .collect()
    )
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.floor(scale * np.array([row["embedding"] for row in first])).astype(np.int64)
    blocks = stored(_blocks(kept, dimensions, scale, width, pack_rows), "blocks")
    for _ in range(rounds):
        labels = stored(_assign(blocks, centroids, width), "labels")
        centroids = _updated(blocks, labels, centroids, width)

    last = stored(_assign(blocks, centroids, width, with_ids=True), "labels")
    rows = last.select(F.explode(F.arrays_zip("ids", "labels", "distances")).alias("x")).select(
        F.col("x.ids").alias("vec_id"), F.col("x.labels").alias("cluster"), F.col("x.distances").alias("distance")
    )
    # As many rows as centroids.
    totals = {r["cluster"]: r["total"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    texts = [",".join(map(str, centroid)) for centroid in centroids.tolist()]
    about = [(c, n, sum(totals.values()), hashlib.sha256(texts[c].encode()).hexdigest()) for c, n in totals.items()]
    named = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(named), "cluster").select(*[name.split()[0] for name in schema.split(", ")])


def _round_sql(number: int) -> str:
    """SQL of the centroids after one more round: tables ``a`` (assignment) and ``c`` (centroids) by number."""
    return f"""
a{number} as (
  select vec_id, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance
  from (select v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) as distance
        from v join c{number} c on v.d = c.d group by v.vec_id, c.cluster) group by vec_id),
m{number} as (
  select cluster, d, (s - ((s % n + n) % n)) // n as x
  from (select a.cluster, v.d, sum(v.x) as s, count(*) as n from v join a{number} a using (vec_id) group by a.cluster, v.d)),
c{number + 1} as (select c.cluster, c.d, coalesce(m.x, c.x) as x from c{number} c left join m{number} m using (cluster, d))"""


ORACLE = f"""
with kept as (
  select vec_id, embedding from embeddings
  where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMENSIONS}),
v as (select vec_id, d, cast(floor({SCALE}.0::double * embedding[d]::double) as bigint) as x from kept, range(1, {DIMENSIONS + 1}) r(d)),
f as (
  select vec_id, row_number() over (order by sha256('1:' || vec_id)) - 1 as cluster from kept
  qualify row_number() over (order by sha256('1:' || vec_id)) <= {CLUSTERS}),
c0 as (select f.cluster, v.d, v.x from f join v using (vec_id)),
{",".join(_round_sql(n) for n in range(ROUNDS + 1))},
t as (select cluster, sum(distance) as cluster_inertia from a{ROUNDS} group by cluster),
h as (select cluster, sha256(string_agg(x::varchar, ',' order by d)) as centroid_sha256 from c{ROUNDS} group by cluster)
select a.vec_id, a.cluster::int as cluster, a.distance::bigint as distance, t.cluster_inertia::bigint as cluster_inertia,
  (select sum(distance) from a{ROUNDS})::bigint as inertia, h.centroid_sha256
from a{ROUNDS} a join t using (cluster) join h using (cluster)
"""
