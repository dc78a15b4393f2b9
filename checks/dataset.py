"""Loading, storing and preparing examples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.config import MULTI_LABEL, SINGLE_LABEL, Dataset
from lexiloom.operators import prepare
from lexiloom.operators.staging import fresh_path
from lexiloom.schemas import NAMED_EXAMPLES, conform
from lexiloom.sources import readers, writers


def load_splits(spark, sf):
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    folder = fresh_path(spark, "splits")
    train.select("text", "label").write.parquet(f"{folder}/train")
    test.select("text", "label").write.parquet(f"{folder}/test")
    names = [row["label"] for row in labels.orderBy("idx").collect()]
    splits = readers.load_splits(
        spark,
        Dataset("lang_documents", len(names), SINGLE_LABEL),
        {"train": f"{folder}/train", "test": f"{folder}/test"},
        label_names=labels.select("idx", "label"),
    )
    parts = [
        df.select(F.lit(split).alias("split"), "text", "label")
        for split, df in (("train", splits.train), ("test", splits.test))
    ]
    named = splits.labels.select(F.lit("labels").alias("split"), F.col("label").alias("text"), F.col("idx").alias("label"))
    return parts[0].unionByName(parts[1]).unionByName(named)


def load_splits_multi_label(spark, sf):
    """Wide boolean sources in three files; validation rows join train."""
    flags = fx.flags(spark, sf)
    folder = fresh_path(spark, "flags")
    for split in ("train", "validation", "test"):
        flags.where(fx.split_of(F.col("ID")) == split).write.parquet(f"{folder}/{split}")
    paths = {split: f"{folder}/{split}" for split in ("train", "validation", "test")}
    splits = readers.load_splits(spark, Dataset("flag_documents", 2, MULTI_LABEL), paths)
    parts = [
        df.select(F.lit(split).alias("split"), "text", fx.ints("labels").alias("labels"))
        for split, df in (("train", splits.train), ("test", splits.test))
    ]
    named = splits.labels.select(
        F.lit("labels").alias("split"), F.col("label").alias("text"), F.col("idx").cast("string").alias("labels")
    )
    return parts[0].unionByName(parts[1]).unionByName(named)


def named_examples(spark, sf):
    """Examples with the name beside the index, in the schema of the denormalised table."""
    examples, labels = fx.lang_examples(spark, sf)
    return conform(prepare.attach_label_name(examples, labels, "label", "label_name"), NAMED_EXAMPLES, ("doc_id",))


def read_table(spark, sf):
    return readers.read_table(spark, f"{sf}/documents.parquet")


def table_files(spark, sf):
    files = readers.table_files(readers.read_table(spark, f"{sf}/documents.parquet"))
    return files.select(F.substring_index("file_path", "/", -1).alias("file_name"), "n_rows")


def save_table(spark, sf):
    examples, _ = fx.lang_examples(spark, sf)
    name = "lexiloom_examples"
    # The path is new for every call; dropping the old entry leaves its files alone.
    writers.drop_table(spark, name)
    writers.save_table(examples, name, path=fresh_path(spark, "saved"))
    return readers.read_table(spark, name)


def replace_table(spark, sf):
    examples, labels = fx.lang_examples(spark, sf)
    name = "lexiloom_replaced"
    writers.replace_table(labels, name, path=fresh_path(spark, "old"))
    writers.replace_table(examples, name, path=fresh_path(spark, "new"))
    return readers.read_table(spark, name)


def preview(spark, sf):
    return writers.preview(fx.table(spark, sf, "documents").select("doc_id", "text", "lang"), ["doc_id"], 5)


def single_label_examples(spark, sf):
    examples, _ = fx.lang_examples(spark, sf)
    return prepare.single_label_examples(examples, keep=("doc_id",))


def multi_label_pack(spark, sf):
    packed = prepare.multi_label_pack(fx.flags(spark, sf), ["quality", "toxic"], keep=("ID",))
    return packed.select(F.col("ID").alias("doc_id"), "text", fx.ints(F.col("labels").cast("array<int>")).alias("labels"))


def label_dimension(spark, sf):
    of_rows = fx.lang_labels(spark, sf).select(F.lit("lang").alias("dataset"), "idx", "label")
    names = prepare.label_columns(fx.flags(spark, sf))
    of_columns = prepare.label_dimension_of_columns(spark, names)
    return of_rows.unionByName(of_columns.select(F.lit("flags").alias("dataset"), "idx", "label"))


def rename_prune(spark, sf):
    return prepare.rename_prune(fx.flags(spark, sf), "Tweet", ["ID", "text"])


def split_flag(spark, sf):
    return prepare.split_flag(fx.documents(spark, sf).select("doc_id", "text"), True)


def split_filter(spark, sf):
    both = fx.documents(spark, sf).select("doc_id", "text", (F.col("doc_id") % 5 != 0).cast("int").alias("is_train"))
    train, test = prepare.split_filter(both, True), prepare.split_filter(both, False)
    return train.select(F.lit("train").alias("split"), "*").unionByName(test.select(F.lit("test").alias("split"), "*"))


def shuffle_rows(spark, sf):
    return prepare.shuffle_rows(fx.table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])


def attach_label_name(spark, sf):
    examples, labels = fx.lang_examples(spark, sf)
    return prepare.attach_label_name(examples.select("doc_id", "text", "label"), labels)


def label_to_index(spark, sf):
    rows = fx.documents(spark, sf).select("doc_id", F.col("lang").alias("label_name"))
    return prepare.label_to_index(rows, fx.lang_labels(spark, sf))


def _three(spark, sf):
    examples, _ = fx.lang_examples(spark, sf)
    return [examples.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]


def union_train_test(spark, sf):
    train, test = fx.train_test(fx.lang_examples(spark, sf)[0])
    return prepare.union_train_test(train, test)


def merge_validation(spark, sf):
    train, validation, _ = _three(spark, sf)
    return prepare.merge_validation(train, validation)


def merge_all_splits(spark, sf):
    merged = prepare.merge_all_splits(*_three(spark, sf))
    again = prepare.split_filter(merged, True).unionByName(prepare.split_filter(merged, False))
    return again.select("doc_id", "text", "label", "is_train")


QUERIES = {
    f.__name__: f
    for f in (
        load_splits, load_splits_multi_label, named_examples, read_table, table_files, save_table, replace_table, preview, single_label_examples,
        multi_label_pack, label_dimension, rename_prune, split_flag, split_filter, shuffle_rows,
        attach_label_name, label_to_index, union_train_test, merge_validation, merge_all_splits,
    )
}

_ROWS = f"WITH {fx.LANG} SELECT doc_id, text, label, split FROM examples"

ORACLES = {
    "load_splits": f"""WITH {fx.LANG}
SELECT CASE is_train WHEN 1 THEN 'train' ELSE 'test' END AS split, text, label FROM examples
UNION ALL SELECT 'labels', lang, label FROM langs""",
    "load_splits_multi_label": f"""WITH {fx.FLAGS}
SELECT CASE is_train WHEN 1 THEN 'train' ELSE 'test' END AS split, text,
  array_to_string(list_transform(labels, lambda x: printf('%.1f', x)), ',') AS labels FROM examples
UNION ALL SELECT * FROM (VALUES ('labels', 'quality', '0'), ('labels', 'toxic', '1'))""",
    "named_examples": f"WITH {fx.LANG} SELECT doc_id, text, label, lang AS label_name FROM examples",
    "read_table": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "table_files": "SELECT 'documents.parquet' AS file_name, count(*) AS n_rows FROM documents",
    "save_table": _ROWS,
    "replace_table": _ROWS,
    "preview": "SELECT doc_id, text, lang FROM documents ORDER BY doc_id LIMIT 5",
    "single_label_examples": f"WITH {fx.LANG} SELECT doc_id, text, label FROM examples",
    "multi_label_pack": """SELECT d.doc_id, d.text,
  (CASE WHEN quality = 1 THEN '1' ELSE '0' END) || ',' || (CASE WHEN toxic = 1 THEN '1' ELSE '0' END) AS labels
FROM documents d JOIN labels l USING (doc_id)""",
    "label_dimension": f"""WITH {fx.LANG}
SELECT 'lang' AS dataset, CAST(label AS INTEGER) AS idx, lang AS label FROM langs
UNION ALL VALUES ('flags', 0, 'quality'), ('flags', 1, 'toxic')""",
    "rename_prune": 'SELECT d.doc_id AS "ID", d.text FROM documents d JOIN labels l USING (doc_id)',
    "split_flag": "SELECT doc_id, text, 1 AS is_train FROM documents",
    "split_filter": """SELECT CASE WHEN doc_id % 5 <> 0 THEN 'train' ELSE 'test' END AS split, doc_id, text,
  CAST(doc_id % 5 <> 0 AS INTEGER) AS is_train FROM documents""",
    # A permutation has the same rows as its table.
    "shuffle_rows": "SELECT doc_id, text FROM documents",
    "attach_label_name": f"WITH {fx.LANG} SELECT doc_id, text, label, lang AS label_name FROM examples",
    "label_to_index": f"WITH {fx.LANG} SELECT doc_id, lang AS label_name, label FROM examples",
    "union_train_test": f"WITH {fx.LANG} SELECT doc_id, text, label, is_train FROM examples",
    "merge_validation": f"WITH {fx.LANG} SELECT doc_id, text, label FROM examples WHERE split <> 'test'",
    "merge_all_splits": f"WITH {fx.LANG} SELECT doc_id, text, label, is_train FROM examples",
}
