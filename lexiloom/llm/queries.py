"""Registered queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexiloom.llm import (
    centroids, chat, collocations, decontaminate, html_text, knn_quality, license_scan, near_dedup, packing, pii, quality_rules,
    substring_dedup, url_filter,
)
from lexiloom.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(F.lit(-1).cast("long"), F.col("id"), role, F.lit(chat.PROBE))
    return chat.report(chat.canonical(rows.union(probe)))


def op2_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return knn_quality.score(docs, knn_quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_knn_quality": op2_knn_quality,
    "op3_url_filter": op3_url_filter,
    "op4_pii": op4_pii,
    "op5_near_dedup": op5_near_dedup,
    "op6_html_text": op6_html_text,
    "op7_license_scan": op7_license_scan,
    "op8_decontaminate": op8_decontaminate,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_centroids": op12_centroids,
    "op13_substring_dedup": op13_substring_dedup,
}

ORACLES = {
    "op1_chat_format": chat.ORACLE,
    "op3_url_filter": url_filter.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_centroids": centroids.ORACLE,
}
