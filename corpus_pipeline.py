"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. Its result is written to the
folder that ``spark.checkpoint.dir`` names and read again as the documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiloom.llm import decontaminate, near_dedup, packing, pii, quality_rules
from lexiloom.llm.common import stored, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.mask(docs, pii.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", rules),
    ("near_dedup", dedup),
    ("decontamination", decontaminated),
    ("pii", private),
    ("packing", packed),
]

# Fitting, signatures and packing can't be said in SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
