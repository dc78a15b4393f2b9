"""Models in 8-bit steps: made, scored, compared with the full model, and their sizes where they are stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import flows
from lexiloom.operators import quantized as qt
from lexiloom.operators.evaluate import METRICS
from lexiloom.operators.staging import fresh_path
from lexiloom.sources.models import model_sizes as sizes, save_model, save_quantized


def quantized_model(spark, sf):
    """Steps of all weights of the language model, and the scale of each output."""
    model = qt.quantize_model(flows.lang_model(spark, sf)[3])
    steps = model.steps.select("id", "token", F.posexplode("steps").alias("output", "step"))
    scales = model.scales.select(F.posexplode("scales").alias("output", "scale"))
    return steps.join(F.broadcast(scales), "output").select(
        "id", "token", "output", F.col("step").cast("int").alias("step"), F.round("scale", 8).alias("scale")
    )


def _quantized_scores(spark, sf, limit):
    train, test, _, model = flows.lang_model(spark, sf)
    scored = qt.batch_score_quantized(train.unionByName(test), qt.quantize_model(model), limit=limit)
    return scored.select("doc_id", fx.decimals("probabilities").alias("probabilities"))


def quantized_scores(spark, sf):
    """Scores of all documents by the quantized model."""
    return _quantized_scores(spark, sf, qt.BROADCAST_BYTES)


def quantized_scores_by_key(spark, sf):
    """The same by the way of a model too large to hand to the tasks."""
    return _quantized_scores(spark, sf, 64 * 1024)


def compare_quantized_model(spark, sf):
    """f1 of both models on the test documents and the documents on which they agree, from one pass."""
    _, test, _, model = flows.lang_model(spark, sf)
    both = qt.compare_with_quantized(test, model, qt.quantize_model(model))
    return both.select("model", *[F.round(m, 6).alias(m) for m in METRICS], "same", "n_rows")


def compare_quantized_multi_label(spark, sf):
    """The same for a model of two labels."""
    _, test, _, model = flows.flag_model(spark, sf)
    both = qt.compare_with_quantized(test, model, qt.quantize_model(model))
    return both.select("model", *[F.round(m, 6).alias(m) for m in METRICS], "same", "n_rows")


def model_sizes(spark, sf):
    """Bytes of the files of the stored model and of its quantized form."""
    model = flows.lang_model(spark, sf)[3]
    folder = fresh_path(spark, "models")
    save_model(model, "full", folder)
    save_quantized(qt.quantize_model(model), "int8", folder)
    return sizes(spark, folder, ["full", "int8"])


QUERIES = {
    f.__name__: f
    for f in (
        quantized_model, quantized_scores, quantized_scores_by_key, compare_quantized_model, compare_quantized_multi_label, model_sizes,
    )
}

_STEPS = """scales AS (
  SELECT label, CASE WHEN max(abs(w)) > 0 THEN max(abs(w)) / CAST(127 AS DOUBLE) ELSE 1.0 END AS s FROM weights GROUP BY label),
steps AS (SELECT id, token, label, CAST(round_even(w / s, 0) AS INTEGER) AS q, s FROM weights JOIN scales USING (label)),
whole AS (
  SELECT doc_id, label, sum(q) AS t FROM (SELECT doc_id, unnest({tokens}) AS token FROM examples) JOIN steps USING (token)
  GROUP BY doc_id, label),
raw8 AS (
  SELECT doc_id, b.label AS output, b.b + s * coalesce(t, 0) AS x
  FROM (SELECT doc_id FROM examples) CROSS JOIN bias b JOIN scales USING (label) LEFT JOIN whole USING (doc_id, label))"""
_STEPS = _STEPS.format(tokens=fx.TOKENS)
_SCORES = f"""WITH {flows.LANG_MODEL}, {_STEPS},
shifted AS (SELECT *, exp(x - max(x) OVER (PARTITION BY doc_id)) AS e FROM raw8),
scored AS (
  SELECT doc_id, list(round(e / t, 4) ORDER BY output) AS p
  FROM (SELECT *, sum(e) OVER (PARTITION BY doc_id) AS t FROM shifted) GROUP BY doc_id)
SELECT doc_id, {fx.sql_decimals('p')} AS probabilities FROM scored"""
_RAW = flows.scored_sql("doc_id")

ORACLES = {
    "quantized_model": f"""WITH {flows.LANG_MODEL}, {_STEPS}
SELECT id, token, CAST(label AS INTEGER) AS output, q AS step, round(s, 8) AS scale FROM steps""",
    "quantized_scores": _SCORES,
    "quantized_scores_by_key": _SCORES,
    "compare_quantized_model": f"""WITH {flows.LANG_MODEL}, {_RAW}, {_STEPS},
a AS (SELECT doc_id, arg_max(output, (x, -output)) AS k FROM raw GROUP BY doc_id),
b AS (SELECT doc_id, arg_max(output, (x, -output)) AS k FROM raw8 GROUP BY doc_id),
pair AS (SELECT label, a.k AS k, b.k AS k8 FROM examples JOIN a USING (doc_id) JOIN b USING (doc_id) WHERE is_train = 0),
hits AS (SELECT 'full' AS model, k = label AS hit, k = k8 AS same FROM pair UNION ALL SELECT 'quantized', k8 = label, k = k8 FROM pair)
SELECT model, round(avg(CAST(hit AS DOUBLE)), 6) AS f1, round(avg(CAST(hit AS DOUBLE)), 6) AS "precision",
  round(avg(CAST(hit AS DOUBLE)), 6) AS recall, count(*) FILTER (WHERE same) AS same, count(*) AS n_rows FROM hits GROUP BY model""",
    "compare_quantized_multi_label": f"""WITH {flows.FLAG_MODEL}, {_RAW}, {_STEPS},
grid8 AS (
  SELECT doc_id, output, labels[output + 1] = 1.0 AS y, 1 / (1 + exp(-raw.x)) >= 0.5 AS p, 1 / (1 + exp(-raw8.x)) >= 0.5 AS p8
  FROM examples JOIN raw USING (doc_id) JOIN raw8 USING (doc_id, output) WHERE is_train = 0),
agreed AS (SELECT count(*) FILTER (WHERE same) AS same, count(*) AS n_rows FROM (SELECT bool_and(p = p8) AS same FROM grid8 GROUP BY doc_id)),
marked AS (SELECT 'full' AS model, p, y FROM grid8 UNION ALL SELECT 'quantized', p8, y FROM grid8),
pooled AS (
  SELECT model, CAST(count(*) FILTER (WHERE p AND y) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE p AND NOT y) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE y AND NOT p) AS DOUBLE) AS fn FROM marked GROUP BY model)
SELECT model, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, same, n_rows FROM pooled CROSS JOIN agreed""",
}
