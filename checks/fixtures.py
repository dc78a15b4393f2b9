"""Example tables derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexiloom.operators.prepare import label_dimension, label_to_index, multi_label_pack
from lexiloom.sources.readers import spread

VOCABULARY = 30_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Setting of the session: into how many partitions the examples are spread; as read without it.
PARTITIONS = "spark.lexiloom.input.partitions"


def input_partitions(spark: SparkSession) -> int | None:
    number = spark.conf.get(PARTITIONS, None)
    return int(number) if number else None


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id", input_partitions(spark))


def split_of(key: Column) -> Column:
    rest = key % 5
    return F.when(rest == 0, "test").when(rest == 1, "validation").otherwise("train")


def lang_labels(spark: SparkSession, sf: str) -> DataFrame:
    return label_dimension(table(spark, sf, "documents"), "lang")


def lang_examples(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, label, split) with the language as label, and the label dimension."""
    labels = lang_labels(spark, sf)
    rows = label_to_index(documents(spark, sf), labels, "lang", "label")
    return rows.select("doc_id", "text", "label", split_of(F.col("doc_id")).alias("split")), labels


def train_test(examples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validation rows belong to train."""
    rows = examples.drop("split")
    return rows.where(F.col("doc_id") % 5 != 0), rows.where(F.col("doc_id") % 5 == 0)


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text, quality, toxic) of the documents with labels."""
    return documents(spark, sf).select("doc_id", "text").join(table(spark, sf, "labels"), "doc_id")


def flags(spark: SparkSession, sf: str) -> DataFrame:
    """Wide multi-label source: one boolean column per label."""
    return judged(spark, sf).select(
        F.col("doc_id").alias("ID"),
        F.col("text").alias("Tweet"),
        (F.col("quality") == 1).alias("quality"),
        (F.col("toxic") == 1).alias("toxic"),
    )


def flag_examples(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text, labels array<float>) in the slot order quality, toxic."""
    return multi_label_pack(flags(spark, sf), ["quality", "toxic"], keep=("ID",)).withColumnRenamed("ID", "doc_id")


def by_slot(n: int, shift: int = 0) -> Column:
    """n sums over a whole vector: value k goes to slot (k + shift) modulo n."""
    values = F.col("embedding").cast("array<double>")

    def total(slot: Column) -> Column:
        mine = F.filter(values, lambda _, k: (k + F.lit(shift)) % n == slot)
        return F.aggregate(mine, F.lit(0.0), lambda acc, x: acc + x)

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), total)


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, logits, label): raw single-label outputs."""
    return table(spark, sf, "embeddings").select("vec_id", by_slot(10).alias("logits"), F.col("label").cast("long").alias("label"))


def multi_logits(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, logits, labels): raw outputs of 11 labels with their truth."""
    raw = F.transform(by_slot(11), lambda x: x * 10)
    truth = F.transform(by_slot(11, 3), lambda x: F.when(x > 0.1, 1.0).otherwise(0.0).cast("float"))
    return table(spark, sf, "embeddings").select("vec_id", raw.alias("logits"), truth.alias("labels"))


def digit_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Label dimension of the embeddings: index k is named label_k."""
    names = table(spark, sf, "embeddings").select(F.concat(F.lit("label_"), F.col("label").cast("string")).alias("name"))
    return label_dimension(names, "name")


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Metric log of 16 runs from the events: one loss and one evaluation entry per epoch."""
    events = table(spark, sf, "events")
    per_epoch = events.groupBy(
        F.concat(F.lit("run_"), (F.col("user_id") % 16).cast("string")).alias("run_id"),
        (F.col("event_id") % 10 + 1).cast("double").alias("epoch"),
    ).agg(
        F.round(F.avg(F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)), 4).alias("f1"),
        F.round(F.avg("value"), 4).alias("loss"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )

    def entry(kind: str, metric: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(metric).alias("metric"), value.alias("value"))

    entries = F.array(
        entry("loss", "loss", F.col("loss")),
        entry("loss", "step", F.col("epoch") * 100),
        entry("eval", "f1", F.col("f1")),
        entry("eval", "eval_runtime", F.col("n")),
        entry("eval", "step", F.col("epoch") * 100),
    )
    return per_epoch.select("run_id", "epoch", F.inline(entries))


def ints(values: str | Column) -> Column:
    """An array as comma-separated text."""
    values = F.col(values) if isinstance(values, str) else values
    return F.array_join(values.cast("array<string>"), ",")


def decimals(values: str | Column) -> Column:
    """Scores as comma-separated text with four digits."""
    return F.array_join(F.transform(values, lambda x: F.format_string("%.4f", x)), ",")


# --- the same in SQL -------------------------------------------------------------------------

TOKENS = "list_filter(string_split(lower(text), ' '), lambda t: t <> '')"


def sql_decimals(expression: str) -> str:
    return f"array_to_string(list_transform({expression}, lambda x: printf('%.4f', x)), ',')"


LANG = """langs AS (
  SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS BIGINT) AS label
  FROM (SELECT DISTINCT lang FROM documents)),
examples AS (
  SELECT doc_id, text, lang, label, CAST(doc_id % 5 <> 0 AS INTEGER) AS is_train,
    CASE doc_id % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split
  FROM documents JOIN langs USING (lang))"""

FLAGS = """examples AS (
  SELECT d.doc_id, d.text, CAST(d.doc_id % 5 <> 0 AS INTEGER) AS is_train,
    [CASE WHEN l.quality = 1 THEN 1.0 ELSE 0.0 END, CASE WHEN l.toxic = 1 THEN 1.0 ELSE 0.0 END] AS labels
  FROM documents d JOIN labels l USING (doc_id))"""



def sql_by_slot(n: int, shift: int = 0) -> str:
    """The sums of :func:`by_slot`, added in the same order."""
    return f"""list_transform(range({n}), lambda s: list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(
      list_filter(range(len(embedding)), lambda k: (k + {shift}) % {n} = s), lambda k: CAST(embedding[k + 1] AS DOUBLE))),
      lambda a, b: a + b))"""


LOGITS = f"""examples AS (
  SELECT vec_id, {sql_by_slot(10)} AS logits, CAST(label AS BIGINT) AS label FROM embeddings)"""

MULTI_LOGITS = f"""examples AS (
  SELECT vec_id, list_transform({sql_by_slot(11)}, lambda x: x * 10) AS logits,
    list_transform({sql_by_slot(11, 3)}, lambda x: CASE WHEN x > 0.1 THEN 1.0 ELSE 0.0 END) AS labels
  FROM embeddings)"""

SQL_SOFTMAX = """list_transform(list_transform(logits, lambda x: exp(x - list_max(logits))),
    lambda e: e / list_sum(list_transform(logits, lambda x: exp(x - list_max(logits)))))"""

RUN_LOG = """epochs AS (
  SELECT 'run_' || CAST(user_id % 16 AS VARCHAR) AS run_id, CAST(event_id % 10 + 1 AS DOUBLE) AS epoch,
    round(avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END), 4) AS f1,
    round(avg(value), 4) AS loss
  FROM events GROUP BY 1, 2)"""


def vocabulary_sql(size: int, source: str = "documents", where: str = "") -> str:
    return f"""words AS (
  SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS}) AS token FROM {source} {where})
  GROUP BY token ORDER BY n DESC, token LIMIT {size}),
vocabulary AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS id, false AS is_special FROM words
  UNION ALL SELECT * FROM (VALUES ('[PAD]', 0, true), ('[UNK]', 1, true), ('[CLS]', 2, true), ('[SEP]', 3, true)))"""


def encoded_sql(max_length: int | None, source: str = "documents", key: str = "doc_id") -> str:
    """(key, input_ids) of every row; needs ``vocabulary``."""
    return f"""kept AS (
  SELECT {key}, {f"list_slice({TOKENS}, 1, {max_length - 2})" if max_length else TOKENS} AS tokens FROM {source}),
pieces AS (
  SELECT {key}, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM kept),
found AS (
  SELECT p.{key}, list(coalesce(v.id, 1) ORDER BY p.pos) AS ids
  FROM pieces p LEFT JOIN vocabulary v ON v.token = p.token AND NOT v.is_special GROUP BY p.{key}),
encoded AS (
  SELECT k.{key}, list_concat(list_concat([2], coalesce(f.ids, [])), [3]) AS input_ids
  FROM kept k LEFT JOIN found f USING ({key}))"""
