"""Profiling, tokenization, batches and token vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.config import MAX_LENGTH, SEED, TRAIN_BATCH
from lexiloom.functions.text import encoded_length
from lexiloom.operators import encode as enc
from lexiloom.operators import prepare, profile, token_vectors as vec
from lexiloom.operators.vocabulary import build_vocabulary
from lexiloom.sources.readers import spread

SHORT = 90
#: Batches small enough that the smallest tables have several stretches of them.
SMALL_BATCH, MEGA = 16, 5


def row_counts(spark, sf):
    train, test = fx.train_test(fx.documents(spark, sf).select("doc_id", "text"))
    labels = fx.table(spark, sf, "documents").select("lang").distinct()
    scoring = prepare.union_train_test(train, test).select("text").where(F.col("text").isNotNull())
    return profile.row_counts({"train": train, "test": test, "labels": labels, "scoring": scoring})


def token_length(spark, sf):
    return profile.token_lengths(fx.documents(spark, sf), keep=("doc_id",))


def token_length_histogram(spark, sf):
    return profile.token_length_histogram(fx.documents(spark, sf))


def token_length_quartiles(spark, sf):
    return profile.length_quantiles(fx.documents(spark, sf), profile.QUARTILES)


def token_length_deciles(spark, sf):
    return profile.length_quantiles(fx.documents(spark, sf), profile.DECILES)


def _encoded(spark, sf, max_length=MAX_LENGTH):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    vocabulary = build_vocabulary(docs, fx.VOCABULARY)
    return enc.encode(docs, vocabulary, max_length=max_length).select("doc_id", "input_ids"), vocabulary


def _encoded_lengths(spark, sf):
    return fx.documents(spark, sf).select("doc_id", encoded_length("text", MAX_LENGTH).alias("encoded_length"))


def _encoded_histogram(spark, sf):
    return profile.length_histogram(_encoded_lengths(spark, sf), "encoded_length")


def encoded_length_histogram(spark, sf):
    return profile.order_by_length(_encoded_histogram(spark, sf), "encoded_length")


def encoded_length_deciles_of_groups(spark, sf):
    histogram = _encoded_histogram(spark, sf)
    return profile.histogram_quantiles(histogram, profile.DECILES, "encoded_length", weight=None)


def order_by_length(spark, sf):
    return profile.order_by_length(profile.length_histogram(profile.token_lengths(fx.documents(spark, sf))))


def test_leak(spark, sf):
    train, test = fx.train_test(fx.documents(spark, sf).select("doc_id", "text"))
    return profile.leaked_rows(train, test)


def vocabulary(spark, sf):
    return build_vocabulary(fx.documents(spark, sf), fx.VOCABULARY)


def encode(spark, sf):
    return _encoded(spark, sf)[0].select("doc_id", fx.ints("input_ids").alias("input_ids"))


def truncate(spark, sf):
    encoded, _ = _encoded(spark, sf, SHORT)
    return encoded.select("doc_id", F.size("input_ids").alias("n_ids"), fx.ints("input_ids").alias("input_ids"))


def pad_fixed(spark, sf):
    encoded, _ = _encoded(spark, sf, SHORT)
    return enc.pad_fixed(encoded, SHORT).select("doc_id", fx.ints("input_ids").alias("input_ids"))


def attention_mask(spark, sf):
    encoded, _ = _encoded(spark, sf, SHORT)
    return enc.pad_fixed(encoded, SHORT).select("doc_id", fx.ints("attention_mask").alias("attention_mask"))


def assign_batches(spark, sf):
    rows = spread(fx.table(spark, sf, "conversations").select("conv_id", "turn"), "conv_id", fx.input_partitions(spark))
    return enc.assign_batches(rows, ["conv_id", "turn"], TRAIN_BATCH)


def pad_to_longest(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    vocabulary = build_vocabulary(docs, fx.VOCABULARY)
    # Lengths are known without encoding, so the texts stay where they are.
    plan = enc.batch_widths(_encoded_lengths(spark, sf), ["doc_id"], TRAIN_BATCH, "encoded_length")
    encoded = enc.encode(docs, vocabulary).select("doc_id", "input_ids")
    return enc.pad_in_batches(encoded, plan, "doc_id").select(
        "doc_id", "batch", fx.ints("input_ids").alias("input_ids"), fx.ints("attention_mask").alias("attention_mask")
    )


def pad_to_longest_of_batches(spark, sf):
    """The same from rows that carry their batch."""
    docs = fx.documents(spark, sf).select("doc_id", "text")
    vocabulary = build_vocabulary(docs, fx.VOCABULARY)
    batched = enc.assign_batches(docs, ["doc_id"], TRAIN_BATCH)
    encoded = enc.encode(batched, vocabulary).select("doc_id", "batch", "input_ids")
    return enc.pad_to_longest(encoded).select(
        "doc_id", "batch", fx.ints("input_ids").alias("input_ids"), fx.ints("attention_mask").alias("attention_mask")
    )


def _shuffled(spark, sf):
    return enc.group_by_length_shuffled(_encoded_lengths(spark, sf), SMALL_BATCH, "encoded_length", "doc_id", SEED, MEGA)


def group_by_length_shuffled(spark, sf):
    """Batches of similar length as a loader makes them: in random stretches, in random order."""
    return _shuffled(spark, sf).select("doc_id", "encoded_length", "idx", "batch")


def padding_cost_shuffled(spark, sf):
    """What padding costs under these batches."""
    return enc.batches_cost(_shuffled(spark, sf), "by_length_shuffled")


def group_by_length(spark, sf):
    lengths = _encoded_lengths(spark, sf).withColumnRenamed("encoded_length", "n_ids")
    return enc.group_by_length(lengths, TRAIN_BATCH, "n_ids", "doc_id")


def padding_cost(spark, sf):
    return enc.padding_cost(_encoded_lengths(spark, sf), TRAIN_BATCH, "doc_id")


def decode(spark, sf):
    encoded, words = _encoded(spark, sf, None)
    return enc.decode(encoded, words).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def _positions(spark, sf):
    """Token ids of all documents in a vocabulary as large as the vector table."""
    docs = fx.documents(spark, sf).select("doc_id", "text")
    vectors = fx.table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("vector"))
    words = build_vocabulary(docs, 400)
    return enc.encode(docs, words, max_length=None).select("doc_id", "input_ids"), vectors


def _summary():
    return [
        F.size("vector").alias("dimension"),
        F.get("vector", F.lit(0)).cast("double").alias("first_value"),
        F.get("vector", F.lit(63)).cast("double").alias("last_value"),
    ]


def token_vectors(spark, sf):
    encoded, vectors = _positions(spark, sf)
    return vec.token_vectors(encoded, vectors).select("doc_id", "pos", "id", *_summary())


def first_position_vector(spark, sf):
    encoded, vectors = _positions(spark, sf)
    return vec.first_position_vector(encoded, vectors).select("doc_id", "id", *_summary())


def vector_shape(spark, sf):
    encoded, vectors = _positions(spark, sf)
    return vec.vector_shape(vec.token_vectors(encoded, vectors))


QUERIES = {
    f.__name__: f
    for f in (
        row_counts, token_length, token_length_histogram, token_length_quartiles, token_length_deciles,
        encoded_length_histogram, encoded_length_deciles_of_groups, order_by_length, test_leak, encode, truncate,
        pad_fixed, attention_mask, assign_batches, pad_to_longest, pad_to_longest_of_batches, group_by_length,
        group_by_length_shuffled, padding_cost, padding_cost_shuffled, decode,
        token_vectors, first_position_vector, vector_shape,
    )
}
QUERIES["build_vocabulary"] = vocabulary

_LENGTHS = "lengths AS (SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS token_length FROM documents)"
_HISTOGRAM = f"WITH {_LENGTHS} SELECT token_length, count(*) AS n_rows FROM lengths GROUP BY token_length"


def _quantiles_sql(ctes: str, source: str, column: str, grid: list[float]) -> str:
    """The value of rank ceil(p * n), in double arithmetic."""
    picks = ", ".join(f"(CAST({p!r} AS DOUBLE))" for p in grid)
    return f"""WITH {ctes},
ranked AS (SELECT {column}, row_number() OVER (ORDER BY {column}) AS r, count(*) OVER () AS n FROM {source})
SELECT probability, {column} FROM ranked JOIN (VALUES {picks}) v(probability)
  ON r = greatest(1, CAST(ceil(probability * n) AS BIGINT))"""


_VOCABULARY = fx.vocabulary_sql(fx.VOCABULARY)
_LONG = f"{_VOCABULARY}, {fx.encoded_sql(MAX_LENGTH)}"
_WHOLE = f"{_VOCABULARY}, {fx.encoded_sql(None)}"
_CUT = f"{_VOCABULARY}, {fx.encoded_sql(SHORT)}"
_GROUPS = f"{_LONG}, hist AS (SELECT CAST(len(input_ids) AS INTEGER) AS encoded_length, count(*) AS n_rows FROM encoded GROUP BY 1)"
_PAD = f"list_concat(input_ids, list_resize(CAST([] AS INTEGER[]), {SHORT} - len(input_ids), 0))"
_POSITIONS = f"""{fx.vocabulary_sql(400)}, {fx.encoded_sql(None)},
positions AS (
  SELECT p.doc_id, CAST(p.pos AS INTEGER) AS pos, p.id, CAST(len(e.embedding) AS INTEGER) AS dimension,
    CAST(e.embedding[1] AS DOUBLE) AS first_value, CAST(e.embedding[64] AS DOUBLE) AS last_value
  FROM (SELECT doc_id, unnest(input_ids) AS id, generate_subscripts(input_ids, 1) - 1 AS pos FROM encoded) p
  LEFT JOIN embeddings e ON e.vec_id = p.id)"""


def _batches(order: str) -> str:
    return f"""SELECT len(input_ids) AS n, (row_number() OVER (ORDER BY {order}) - 1) // {TRAIN_BATCH} AS batch FROM encoded"""


def _padded(order: str) -> str:
    return f"SELECT sum(m * c) FROM (SELECT max(n) AS m, count(*) AS c FROM ({_batches(order)}) GROUP BY batch)"


_SHUFFLED = f"""{_LONG},
placed AS (
  SELECT doc_id, CAST(len(input_ids) AS INTEGER) AS n, md5('{SEED}:' || CAST(doc_id AS VARCHAR)) AS h,
    row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place FROM encoded),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY place // {SMALL_BATCH * MEGA} ORDER BY n DESC, h, doc_id) - 1 AS r FROM placed),
cut AS (SELECT *, (place // {SMALL_BATCH * MEGA}) * {MEGA} + r // {SMALL_BATCH} AS b FROM ranked),
batches AS (
  SELECT b, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(b AS VARCHAR)), b) - 1 AS batch FROM (SELECT DISTINCT b FROM cut)),
shuffled AS (
  SELECT doc_id, n, batch, row_number() OVER (ORDER BY batch, r % {SMALL_BATCH}) - 1 AS idx FROM cut JOIN batches USING (b))"""

ORACLES = {
    "row_counts": """SELECT CASE WHEN doc_id % 5 <> 0 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows
FROM documents GROUP BY 1
UNION ALL SELECT 'labels', count(DISTINCT lang) FROM documents
UNION ALL SELECT 'scoring', count(text) FROM documents""",
    "token_length": f"WITH {_LENGTHS} SELECT doc_id, token_length FROM lengths",
    "token_length_histogram": _HISTOGRAM,
    "token_length_quartiles": _quantiles_sql(_LENGTHS, "lengths", "token_length", profile.QUARTILES),
    "token_length_deciles": _quantiles_sql(_LENGTHS, "lengths", "token_length", profile.DECILES),
    "encoded_length_histogram": f"WITH {_GROUPS} SELECT encoded_length, n_rows FROM hist",
    "encoded_length_deciles_of_groups": _quantiles_sql(_GROUPS, "hist", "encoded_length", profile.DECILES),
    "order_by_length": f"{_HISTOGRAM} ORDER BY token_length",
    "test_leak": """SELECT count(*) AS test_rows,
  count(*) FILTER (WHERE text IN (SELECT text FROM documents WHERE doc_id % 5 <> 0)) AS leaked_rows
FROM documents WHERE doc_id % 5 = 0""",
    "build_vocabulary": f"WITH {_VOCABULARY} SELECT token, id, is_special FROM vocabulary",
    "encode": f"WITH {_LONG} SELECT doc_id, array_to_string(input_ids, ',') AS input_ids FROM encoded",
    "truncate": f"""WITH {_CUT}
SELECT doc_id, CAST(len(input_ids) AS INTEGER) AS n_ids, array_to_string(input_ids, ',') AS input_ids FROM encoded""",
    "pad_fixed": f"WITH {_CUT} SELECT doc_id, array_to_string({_PAD}, ',') AS input_ids FROM encoded",
    "attention_mask": f"""WITH {_CUT}
SELECT doc_id, array_to_string(list_transform({_PAD}, lambda x, i: CASE WHEN i <= len(input_ids) THEN 1 ELSE 0 END), ',')
  AS attention_mask FROM encoded""",
    "assign_batches": f"""SELECT conv_id, turn, idx, idx // {TRAIN_BATCH} AS batch
FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM conversations)""",
    "pad_to_longest": f"""WITH {_LONG},
batched AS (SELECT doc_id, input_ids, (row_number() OVER (ORDER BY doc_id) - 1) // {TRAIN_BATCH} AS batch FROM encoded),
sized AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) AS width FROM batched),
filled AS (SELECT *, list_concat(input_ids, list_resize(CAST([] AS INTEGER[]), width - len(input_ids), 0)) AS ids FROM sized)
SELECT doc_id, batch, array_to_string(ids, ',') AS input_ids,
  array_to_string(list_transform(ids, lambda x, i: CASE WHEN i <= len(input_ids) THEN 1 ELSE 0 END), ',') AS attention_mask
FROM filled""",
    "group_by_length": f"""WITH {_LONG},
numbered AS (SELECT doc_id, CAST(len(input_ids) AS INTEGER) AS n_ids,
  row_number() OVER (ORDER BY len(input_ids), doc_id) - 1 AS idx FROM encoded)
SELECT doc_id, n_ids, idx, idx // {TRAIN_BATCH} AS batch FROM numbered""",
    "padding_cost": f"""WITH {_LONG}, total AS (SELECT sum(len(input_ids)) AS n, count(*) AS c FROM encoded)
SELECT 'fixed' AS strategy, CAST(n AS BIGINT) AS real, CAST(c * {MAX_LENGTH} AS BIGINT) AS padded FROM total
UNION ALL SELECT 'dynamic', CAST(n AS BIGINT), CAST(({_padded('doc_id')}) AS BIGINT) FROM total
UNION ALL SELECT 'by_length', CAST(n AS BIGINT), CAST(({_padded('len(input_ids), doc_id')}) AS BIGINT) FROM total""",
    "group_by_length_shuffled": f"WITH {_SHUFFLED} SELECT doc_id, n AS encoded_length, idx, batch FROM shuffled",
    "padding_cost_shuffled": f"""WITH {_SHUFFLED}
SELECT 'by_length_shuffled' AS strategy, CAST(sum(s) AS BIGINT) AS real, CAST(sum(m * c) AS BIGINT) AS padded
FROM (SELECT sum(n) AS s, max(n) AS m, count(*) AS c FROM shuffled GROUP BY batch)""",
    "decode": f"""WITH {_WHOLE},
ids AS (SELECT doc_id, unnest(input_ids) AS id, generate_subscripts(input_ids, 1) AS pos FROM encoded)
SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS tokens FROM ids JOIN vocabulary USING (id) GROUP BY doc_id""",
    "token_vectors": f"WITH {_POSITIONS} SELECT doc_id, pos, id, dimension, first_value, last_value FROM positions",
    "first_position_vector": f"""WITH {_POSITIONS}
SELECT doc_id, id, dimension, first_value, last_value FROM positions WHERE pos = 0""",
    "vector_shape": f"""WITH {_POSITIONS}
SELECT doc_id, count(*) AS sequence_length, max(dimension) AS dimension FROM positions GROUP BY doc_id""",
}

ORACLES["pad_to_longest_of_batches"] = ORACLES["pad_to_longest"]
