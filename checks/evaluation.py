"""Metrics, comparison of models and 8-bit vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.functions.vectors import activation, round_scores
from lexiloom.operators import evaluate as ev


def _rounded(metrics, *by):
    return metrics.select(*by, *[F.round(m, 6).alias(m) for m in ev.METRICS])


def single_label_metrics(spark, sf):
    return _rounded(ev.single_label_metrics(fx.logits(spark, sf)))


def multi_label_metrics(spark, sf):
    return _rounded(ev.multi_label_metrics(fx.multi_logits(spark, sf)))


def metric_report(spark, sf):
    single = ev.metric_report(ev.single_label_metrics(fx.logits(spark, sf)))
    multi = ev.metric_report(ev.multi_label_metrics(fx.multi_logits(spark, sf)))
    return single.select(F.lit("single").alias("problem"), "*").unionByName(
        multi.select(F.lit("multi").alias("problem"), "*")
    )


def _two_models(spark, sf):
    def scores(df):
        return df.select("vec_id", "label", round_scores(activation("logits", "softmax")).alias("probabilities"))

    full = fx.logits(spark, sf)
    packed = ev.quantize_int8(full, "logits", keep=("vec_id", "label"))
    restored = ev.dequantize_int8(packed, keep=("vec_id", "label"), name="logits")
    return scores(full), scores(restored)


def compare_models(spark, sf):
    full, quantized = _two_models(spark, sf)
    metrics = _rounded(ev.compare_models({"full": full, "quantized": quantized}), "model")
    same = ev.agreement(full, quantized, "vec_id")
    return metrics.select("model", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ev.METRICS
    ]))).unionByName(same.select(
        F.lit("both").alias("model"), F.lit("same_label").alias("metric"),
        F.round(F.col("n_same") / F.col("n_rows"), 6).alias("value"),
    ))


def quantize_int8(spark, sf):
    packed = ev.quantize_int8(fx.table(spark, sf, "embeddings"), "embedding", keep=("vec_id",))
    return packed.select("vec_id", F.round("scale", 9).alias("scale"), fx.ints("steps").alias("steps"))


def size_compare(spark, sf):
    return ev.size_compare(fx.table(spark, sf, "embeddings"), "embedding", digits=3)


QUERIES = {
    f.__name__: f
    for f in (single_label_metrics, multi_label_metrics, metric_report, compare_models, quantize_int8, size_compare)
}

_SINGLE = f"""{fx.LOGITS},
hits AS (SELECT avg(CAST(list_position(logits, list_max(logits)) - 1 = label AS DOUBLE)) AS a FROM examples)"""
_MULTI = f"""{fx.MULTI_LOGITS},
cells AS (SELECT unnest(list_transform(logits, lambda x: 1 / (1 + exp(-x)) >= 0.5)) AS p, unnest(labels) = 1.0 AS y FROM examples),
pooled AS (
  SELECT CAST(count(*) FILTER (WHERE p AND y) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE p AND NOT y) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE y AND NOT p) AS DOUBLE) AS fn FROM cells),
multi AS (SELECT coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tp / nullif(tp + fp, 0), 0) AS prec,
  coalesce(tp / nullif(tp + fn, 0), 0) AS rec FROM pooled)"""
_STEPS = """scaled AS (
  SELECT vec_id, {keep}{v} AS v, CASE WHEN m > 0 THEN m / 127.0 ELSE 1.0 END AS s
  FROM (SELECT *, list_max(list_transform({v}, lambda x: abs(CAST(x AS DOUBLE)))) AS m FROM {source})),
steps AS (SELECT *, list_transform(v, lambda x: CAST(round_even(CAST(x AS DOUBLE) / s, 0) AS INTEGER)) AS q FROM scaled)"""
_TWO = f"""{fx.LOGITS}, {_STEPS.format(keep="label, ", v="logits", source="examples")},
models AS (
  SELECT 'full' AS model, vec_id, label, logits FROM examples
  UNION ALL SELECT 'quantized', vec_id, label, list_transform(q, lambda x: x * s) FROM steps),
scores AS (SELECT model, vec_id, label, list_transform({fx.SQL_SOFTMAX}, lambda x: round(x, 4)) AS p FROM models),
first AS (SELECT model, vec_id, label, list_position(p, list_max(p)) - 1 AS k FROM scores)"""

ORACLES = {
    "single_label_metrics": f"""WITH {_SINGLE}
SELECT round(a, 6) AS f1, round(a, 6) AS "precision", round(a, 6) AS recall FROM hits""",
    "multi_label_metrics": f"""WITH {_MULTI}
SELECT round(f1, 6) AS f1, round(prec, 6) AS "precision", round(rec, 6) AS recall FROM multi""",
    "metric_report": f"""SELECT * FROM (WITH {_SINGLE}
  SELECT 'single' AS problem, unnest(['f1', 'precision', 'recall']) AS metric, round(a, 3) AS value FROM hits)
UNION ALL SELECT * FROM (WITH {_MULTI}
  SELECT 'multi', unnest(['f1', 'precision', 'recall']), round(unnest([f1, prec, rec]), 3) FROM multi)""",
    "compare_models": f"""WITH {_TWO}
SELECT model, unnest(['f1', 'precision', 'recall']) AS metric, round(avg(CAST(k = label AS DOUBLE)), 6) AS value
FROM first GROUP BY model
UNION ALL SELECT 'both', 'same_label', round(avg(CAST(a.k = b.k AS DOUBLE)), 6)
FROM first a JOIN first b ON a.vec_id = b.vec_id AND a.model = 'full' AND b.model = 'quantized'""",
    "quantize_int8": f"""WITH {_STEPS.format(keep="", v="embedding", source="embeddings")}
SELECT vec_id, round(s, 9) AS scale, array_to_string(q, ',') AS steps FROM steps""",
    "size_compare": """SELECT round(sum(len(embedding)) * 4 / (1024.0 * 1024.0), 3) AS full_mb,
  round((sum(len(embedding)) + count(*) * 4) / (1024.0 * 1024.0), 3) AS quantized_mb FROM embeddings""",
}
