"""Batches of similar length in random order, and padding by a plan."""

import contextlib
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.functions.text import encoded_length
from lexiloom.operators import encode as enc
from lexiloom.operators.lookup import find, hash_buckets, with_value
from lexiloom.operators.vocabulary import build_vocabulary

SF = "/root/testdata/sf0.001"


def plain(lengths, size, seed, mega):
    """(key, place, batch) as a loader in one process would make them; ``lengths``: key to length."""
    order = lambda x: hashlib.md5(f"{seed}:{x}".encode()).hexdigest()
    keys = sorted(lengths, key=order)
    batches = []
    for start in range(0, len(keys), size * mega):
        stretch = sorted(keys[start : start + size * mega], key=lambda k: (-lengths[k], order(k)))
        batches += [stretch[i : i + size] for i in range(0, len(stretch), size)]
    numbers = []
    for start in range(0, len(keys), size * mega):
        n = -(-min(size * mega, len(keys) - start) // size)
        numbers += [start // size + i for i in range(n)]
    ordered = [batch for _, batch in sorted(zip(numbers, batches), key=lambda x: order(x[0]))]
    at, out = 0, []
    for number, batch in enumerate(ordered):
        for key in batch:
            out.append((key, at, number))
            at += 1
    return sorted(out)


@pytest.mark.parametrize("rows,size,mega", [(0, 4, 2), (1, 4, 2), (203, 7, 3), (64, 8, 2), (100, 3, 50)])
def test_shuffled_batches_equal_a_plain_loader(spark, rows, size, mega):
    values = random.Random(rows)
    lengths = {i * 3: values.randint(1, 9) for i in range(rows)}
    df = spark.createDataFrame(list(lengths.items()), "k long, n int").repartition(5)
    for seed in (1, 2):
        got = enc.group_by_length_shuffled(df, size, "n", "k", seed, mega)
        assert got.columns == ["k", "n", "idx", "batch"]
        assert sorted((r.k, r.idx, r.batch) for r in got.collect()) == plain(lengths, size, seed, mega)


def test_a_plan_pads_like_a_window(spark):
    docs = fx.table(spark, SF, "documents").select("doc_id", "text")
    vocabulary = build_vocabulary(docs, 1000)
    lengths = docs.select("doc_id", encoded_length("text", 64).alias("n"))
    plan = enc.batch_widths(lengths, ["doc_id"], 16, "n")
    encoded = enc.encode(docs, vocabulary, max_length=64).select("doc_id", "input_ids")
    want = enc.pad_to_longest(encoded.join(plan.select("doc_id", "batch"), "doc_id"))
    for limit in (1 << 26, 0):
        got = enc.pad_in_batches(encoded, plan, "doc_id", limit=limit).select(want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        enc.pad_in_batches(encoded, plan, "doc_id").explain("formatted")
    # The side of the texts is scanned, encoded, joined by broadcast and padded in one stage.
    text_side = out.getvalue().split("BroadcastExchange")[0]
    assert "hashpartitioning" not in text_side and "SortMergeJoin" not in out.getvalue().split("===== Subqueries")[0]


def test_costs_of_batches(spark):
    df = spark.createDataFrame([(0, 3), (0, 5), (1, 2)], "batch long, encoded_length int")
    assert tuple(enc.batches_cost(df, "x").first()) == ("x", 10, 12)
    assert tuple(enc.batches_cost(df.limit(0), "x").first()) == ("x", 0, 0)


@pytest.mark.parametrize("rows", [0, 1, 3, 17, 5000])
def test_packed_tables_find_every_key(spark, rows):
    table = spark.range(rows).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.struct(F.array("id").alias("a")).alias("v"))
    packed, n = hash_buckets(table, "k", "v")
    assert packed.select(F.size("buckets")).first()[0] == n
    asked = spark.range(rows + 3).select("id", F.concat(F.lit("k"), F.col("id")).alias("k"))
    got = with_value(asked, "_b", packed).select("id", find(F.col("_b"), F.col("k"), n)["a"][0].alias("v")).collect()
    assert all(r.v == (r.id if r.id < rows else None) for r in got) and len(got) == rows + 3
