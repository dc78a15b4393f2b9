"""Training, scoring, prediction tables and run tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks import fixtures as fx
from lexiloom.config import INFERENCE_BATCH, SINGLE_LABEL, TRAIN_BATCH
from lexiloom.operators import decode as dec
from lexiloom.operators import runs as rn
from lexiloom.operators.epochs import Setting, train_epoch_grid, train_epochs as fit_epochs
from lexiloom.operators.linear import score_linear, train_linear
from lexiloom.operators.prepare import label_dimension_of_columns, union_train_test
from lexiloom.operators.score import batch_score as score, batch_score_with
from lexiloom.operators.staging import fresh_path
from lexiloom.operators.train import count_single_label, train_multi_label as fit_multi, train_single_label as fit_single
from lexiloom.operators.vocabulary import build_vocabulary
from lexiloom.functions.vectors import activation as activate, round_scores as rounded
from lexiloom.plans.grid import grid_runs as run_grid
from lexiloom.plans.multi_label import multi_label_predictions as predict_multi
from lexiloom.plans.single_label import decode_single_label, score_texts, single_label_predictions as predict_single
from lexiloom.sources.models import model_path, save_model

#: All tokens.
SIZE = None
LANG_CLASSES = "SELECT label FROM langs"
SMOOTHINGS = [0.1, 0.5, 1.0, 2.0]


def lang_model(spark, sf):
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    return train, test, labels, fit_single(train, labels.count(), SIZE)


def flag_model(spark, sf):
    examples = fx.flag_examples(spark, sf)
    train, test = fx.train_test(examples)
    return train, test, label_dimension_of_columns(spark, ["quality", "toxic"]), fit_multi(train, 2, SIZE)


def flagship(spark, sf):
    train, test, labels, model = lang_model(spark, sf)
    return predict_single(train, test, labels, model)


def _weight_rows(model):
    named = F.posexplode("weights").alias("output", "weight")
    return model.weights.select("id", F.coalesce("token", F.lit("")).alias("token"), named).select(
        "id", "token", "output", F.round("weight", 6).alias("weight")
    )


def train_single_label(spark, sf):
    return _weight_rows(lang_model(spark, sf)[3])


def train_multi_label(spark, sf):
    return _weight_rows(flag_model(spark, sf)[3])


def linear_single_label(spark, sf):
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    scored = score_linear(union_train_test(train, test), train_linear(train))
    return decode_single_label(scored, labels, keep=("doc_id",)).select(
        "doc_id", "is_train", "label", "predicted_label", "predicted_probability"
    )


def train_epochs(spark, sf):
    """Metrics of the best epoch of a model trained step by step."""
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    vocabulary = build_vocabulary(train, SIZE)
    return rn.best_epoch_metrics(fit_epochs(train, test, vocabulary, labels.count(), SINGLE_LABEL).log)


#: Run id, rate and decay of the models that are trained together.
EPOCH_GRID = {"slow": (0.005, 0.01), "plain": (0.02, 0.01), "decayed": (0.05, 0.5)}


def epoch_grid(spark, sf):
    """Loss and f1 of the first two epochs of several models that are trained in the same passes, all tokens."""
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    settings = {name: Setting(rate, decay, patience=2) for name, (rate, decay) in EPOCH_GRID.items()}
    runs = train_epoch_grid(train, test, build_vocabulary(train, SIZE), labels.count(), SINGLE_LABEL, settings, max_epochs=2)
    log = None
    for run in runs.values():
        log = run.log if log is None else log.unionByName(run.log)
    return log.where("metric in ('loss', 'f1')").select("run_id", "epoch", "metric", F.round("value", 5).alias("value"))


def train_epochs_by_parts(spark, sf):
    """The same for one model whose rare tokens are joined, as in a corpus with too many tokens to hand to the tasks."""
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    run = fit_epochs(
        train, test, build_vocabulary(train, SIZE), labels.count(), SINGLE_LABEL, "plain", max_epochs=2, patience=2, limit=256 * 1024
    )
    return run.log.where("metric in ('loss', 'f1')").select("run_id", "epoch", "metric", F.round("value", 5).alias("value"))


def grid_runs(spark, sf):
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    metrics = run_grid(count_single_label(train, labels.count(), SIZE), test, SMOOTHINGS)
    return metrics.select("smoothing", *[F.round(m, 6).alias(m) for m in ("f1", "precision", "recall")])


def _run(spark, sf):
    """Train and score on the documents, and put the run into a runs table."""
    examples, labels = fx.lang_examples(spark, sf)
    train, test = fx.train_test(examples)
    n_labels = labels.count()
    folder = fresh_path(spark, "run")
    fitted = {}

    def fit():
        fitted["model"] = fit_single(train, n_labels, SIZE)
        save_model(fitted["model"], "nb", f"{folder}/models")

    train_seconds = rn.timed_write(fit)
    predictions = predict_single(train, test, labels, fitted["model"])
    in_test = F.col("is_train") == 0
    seen, score_seconds = rn.observed_write(
        predictions, f"{folder}/predictions",
        train_rows=F.count(F.when(~in_test, 1)),
        eval_rows=F.count(F.when(in_test, 1)),
        hits=F.count(F.when(in_test & (F.col("label_indx") == F.col("predicted_label_indx")), 1)),
    )
    metrics = rn.merged(
        {"f1": round(seen["hits"] / max(seen["eval_rows"], 1), 4)},
        {"model_size_mb": rn.stored_mb(spark, model_path(f"{folder}/models", "nb"))},
        rn.rates("train", train_seconds, seen["train_rows"], TRAIN_BATCH),
        rn.rates("eval", score_seconds, seen["eval_rows"], INFERENCE_BATCH),
        {"inference_seconds": round(score_seconds, 2)},
    )
    params = rn.merged(
        {"dataset": "lang_documents", "num_labels": n_labels, "feature_col": "text", "smoothing": 1.0},
    )
    rn.append_run(rn.run_row(spark, "nb", params, metrics), f"{folder}/runs")
    return rn.read_runs(spark, f"{folder}/runs")


def run_metrics(spark, sf):
    """What a run found, collected by the write of its predictions."""
    return rn.run_metrics(_run(spark, sf), measured=False)


def run_times(spark, sf):
    """What a run took."""
    return rn.run_metrics(_run(spark, sf), measured=True)


def best_epoch_metrics(spark, sf):
    return rn.best_epoch_metrics(fx.run_log(spark, sf))


def best_checkpoint(spark, sf):
    return rn.best_checkpoint(fx.run_log(spark, sf))


def early_stop_epoch(spark, sf):
    return rn.early_stop_epoch(fx.run_log(spark, sf))


def early_stop_epoch_patience_3(spark, sf):
    return rn.early_stop_epoch(fx.run_log(spark, sf), patience=3)


def best_run(spark, sf):
    best = rn.best_checkpoint(fx.run_log(spark, sf))
    dataset = F.when(F.substring_index("run_id", "_", -1).cast("int") % 2 == 0, "even").otherwise("odd")
    return rn.best_run(best.withColumn("dataset", dataset))


def batch_score(spark, sf):
    train, test, _, model = lang_model(spark, sf)
    scored = score(union_train_test(train, test), model)
    return scored.select("doc_id", "is_train", fx.decimals("probabilities").alias("probabilities"))


def batch_score_by_key(spark, sf):
    """The same scores by the way of a model too large to hand to the tasks."""
    train, test, _, model = lang_model(spark, sf)
    scored = score(union_train_test(train, test), model, key="doc_id", limit=64 * 1024)
    return scored.select("doc_id", "is_train", fx.decimals("probabilities").alias("probabilities"))


def batch_score_plug_in(spark, sf):
    """A scorer of the user's that knows a text by its length only."""

    def load():
        def predict(texts):
            rest = np.array([len(text) % 10 for text in texts]) / 10
            return np.stack([rest, 1 - rest], axis=1)

        return predict

    docs = fx.documents(spark, sf).select("doc_id", "text")
    scored = batch_score_with(docs, load, 2)
    return scored.select("doc_id", fx.decimals("probabilities").alias("probabilities"))


def activation(spark, sf):
    logits = fx.logits(spark, sf)
    parts = [
        logits.select("vec_id", F.lit(f).alias("function"), activate("logits", f).alias("p"))
        for f in ("softmax", "sigmoid", "none")
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.select("vec_id", "function", F.posexplode("p").alias("output", "p")).select(
        "vec_id", "function", "output", F.round("p", 6).alias("p")
    )


def _scores(spark, sf):
    return fx.logits(spark, sf).select(
        "vec_id", "label", rounded(activate("logits", "softmax")).alias("probabilities")
    )


def round_scores(spark, sf):
    return _scores(spark, sf).select("vec_id", fx.decimals("probabilities").alias("probabilities"))


def predicted_probability(spark, sf):
    return dec.predicted_probability(_scores(spark, sf)).select("vec_id", "predicted_probability")


def predicted_label_index(spark, sf):
    return dec.predicted_label_index(_scores(spark, sf)).select("vec_id", "predicted_label_indx")


def predicted_label(spark, sf):
    labels = fx.digit_labels(spark, sf)
    chosen = dec.predicted_label_index(_scores(spark, sf)).withColumnRenamed("label", "label_indx")
    named = dec.predicted_label(dec.predicted_label(chosen, labels), labels, "label_indx", "label")
    return named.select("vec_id", "label_indx", "predicted_label_indx", "predicted_label", "label")


def _multi_scores(spark, sf):
    return fx.multi_logits(spark, sf).select(
        "vec_id", "labels", rounded(activate("logits", "sigmoid")).alias("probabilities")
    )


def threshold_indices(spark, sf):
    return dec.threshold_indices(_multi_scores(spark, sf)).select(
        "vec_id", fx.ints("predicted_label_indxs").alias("predicted_label_indxs")
    )


def true_indices(spark, sf):
    return dec.true_indices(_multi_scores(spark, sf)).select("vec_id", fx.ints("label_indxs").alias("label_indxs"))


def _emotions(spark):
    return label_dimension_of_columns(spark, [f"emotion_{k}" for k in range(11)])


def index_names(spark, sf):
    chosen = dec.threshold_indices(_multi_scores(spark, sf))
    named = dec.index_names(chosen, _emotions(spark), "predicted_label_indxs", "predicted_labels")
    return named.select("vec_id", F.array_join("predicted_labels", ",").alias("predicted_labels"))


def index_names_by_key(spark, sf):
    """The same names by the way of a label table too large to hand to the tasks."""
    chosen = dec.threshold_indices(_multi_scores(spark, sf))
    named = dec.index_names(chosen, _emotions(spark), "predicted_label_indxs", "predicted_labels", "vec_id", limit=0)
    return named.select("vec_id", F.array_join("predicted_labels", ",").alias("predicted_labels"))


def single_label_predictions(spark, sf):
    train, test, labels, model = lang_model(spark, sf)
    table = predict_single(train, test, labels, model, keep=("doc_id",))
    return table.withColumn("probabilities", fx.decimals("probabilities")).withColumn(
        "predicted_probability", F.format_string("%.4f", "predicted_probability")
    )


def multi_label_predictions(spark, sf):
    train, test, labels, model = flag_model(spark, sf)
    table = predict_multi(train, test, labels, model, keep=("doc_id",))
    for name in ("all_label_indxs", "pred_proba_label_indxs"):
        table = table.withColumn(name, fx.decimals(name))
    for name in ("predicted_label_indxs", "label_indxs"):
        table = table.withColumn(name, fx.ints(name))
    for name in ("predicted_labels", "labels"):
        table = table.withColumn(name, F.array_join(name, ","))
    return table


def sentiment_score(spark, sf):
    """A model of the two quality labels scores all documents and all turns of conversations."""
    examples = fx.judged(spark, sf).select("doc_id", "text", F.col("quality").cast("long").alias("label"))
    model = fit_single(examples.where(F.col("doc_id") % 5 != 0), 2, SIZE)
    labels = label_dimension_of_columns(spark, ["NEGATIVE", "POSITIVE"])
    turns = fx.table(spark, sf, "conversations").select(F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("key"), "text")
    docs = fx.documents(spark, sf).select(F.concat_ws("-", F.lit("doc"), "doc_id").alias("key"), "text")
    scored = score_texts(docs.unionByName(turns), labels, model)
    return scored.select("key", "label_name", F.format_string("%.4f", "score").alias("score"))


QUERIES = {
    f.__name__: f
    for f in (
        train_single_label, train_multi_label, linear_single_label, train_epochs, epoch_grid, train_epochs_by_parts, grid_runs,
        run_metrics, run_times, best_epoch_metrics,
        best_checkpoint, early_stop_epoch, early_stop_epoch_patience_3, best_run, batch_score, batch_score_by_key,
        batch_score_plug_in,
        activation, round_scores, predicted_probability, predicted_label_index, predicted_label,
        threshold_indices, true_indices, index_names, index_names_by_key, single_label_predictions,
        multi_label_predictions, sentiment_score,
    )
}


def _single_sql(examples: str, classes: str, smoothing: float = 1.0) -> str:
    """Weights of every class of the query ``classes`` (label), from ``examples`` (key, text, label, is_train)."""
    classes = f"classes AS ({classes})"
    return f"""{examples}, {classes},
per_class AS (
  SELECT token, label, count(*) AS n FROM (
    SELECT label, unnest({fx.TOKENS}) AS token FROM examples WHERE is_train = 1) GROUP BY ALL),
words AS (SELECT token, sum(n) AS n FROM per_class GROUP BY token),
numbered AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS id FROM words),
cells AS (
  SELECT id, token, label, coalesce(p.n, 0) AS n
  FROM (SELECT * FROM numbered CROSS JOIN classes) LEFT JOIN per_class p USING (token, label)),
totals AS (SELECT label, sum(n) AS t FROM cells GROUP BY label),
weights AS (
  SELECT id, token, label, ln((n + {smoothing}) / (t + {smoothing} * (SELECT count(*) FROM words))) AS w
  FROM cells JOIN totals USING (label)),
bias AS (
  SELECT label, ln((count(e.label) + {smoothing}) / ((SELECT count(*) FROM examples WHERE is_train = 1)
    + {smoothing} * (SELECT count(*) FROM classes))) AS b
  FROM classes LEFT JOIN (SELECT label FROM examples WHERE is_train = 1) e USING (label) GROUP BY label)"""


def scored_sql(keys: str, target: str = "examples") -> str:
    """Probability list per row of ``target``, from ``weights`` and ``bias``."""
    return f"""sums AS (
  SELECT {keys}, label, sum(w) AS s
  FROM (SELECT {keys}, unnest({fx.TOKENS}) AS token FROM {target}) JOIN weights USING (token) GROUP BY {keys}, label),
raw AS (
  SELECT {keys}, b.label AS output, b.b + coalesce(s.s, 0) AS x
  FROM (SELECT {keys} FROM {target}) CROSS JOIN bias b LEFT JOIN sums s USING ({keys}, label)),
shifted AS (SELECT *, exp(x - max(x) OVER (PARTITION BY {keys})) AS e FROM raw),
scored AS (
  SELECT {keys}, list(round(e / t, 4) ORDER BY output) AS p
  FROM (SELECT *, sum(e) OVER (PARTITION BY {keys}) AS t FROM shifted) GROUP BY {keys})"""


LANG_MODEL = _single_sql(fx.LANG, LANG_CLASSES)

FLAG_MODEL = f"""{fx.FLAGS}, slots AS (SELECT range AS slot FROM range(2)),
train_rows AS (SELECT slot, CAST(labels[slot + 1] = 1.0 AS INTEGER) AS y, text FROM examples, slots WHERE is_train = 1),
per_slot AS (SELECT token, slot, y, count(*) AS n FROM (
  SELECT slot, y, unnest({fx.TOKENS}) AS token FROM train_rows) GROUP BY ALL),
words AS (SELECT token, sum(n) AS n FROM per_slot WHERE slot = 0 GROUP BY token),
numbered AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS id FROM words),
cells AS (
  SELECT id, token, slot, y, coalesce(p.n, 0) AS n
  FROM (SELECT * FROM numbered CROSS JOIN slots CROSS JOIN (VALUES (0), (1)) v(y)) LEFT JOIN per_slot p USING (token, slot, y)),
shares AS (
  SELECT id, token, slot, y, ln((n + 1.0) / (sum(n) OVER (PARTITION BY slot, y) + 1.0 * (SELECT count(*) FROM words))) AS w
  FROM cells),
weights AS (SELECT id, token, slot AS label, sum(CASE y WHEN 1 THEN w ELSE -w END) AS w FROM shares GROUP BY ALL),
bias AS (SELECT slot AS label, ln(sum(y) + 1.0) - ln(sum(1 - y) + 1.0) AS b FROM train_rows GROUP BY slot)"""

_WEIGHTS = """SELECT id, token, CAST(label AS INTEGER) AS output, round(w, 6) AS weight FROM weights
UNION ALL SELECT -1, '', CAST(label AS INTEGER), round(b, 6) FROM bias"""

_LANG_SCORED = f"{LANG_MODEL}, {scored_sql('doc_id')}"


def _hits_sql(smoothing: float) -> str:
    return f"""(WITH {_single_sql(fx.LANG, LANG_CLASSES, smoothing)}, {scored_sql('doc_id')},
first AS (SELECT doc_id, arg_max(output, (x, -output)) AS k FROM raw GROUP BY doc_id)
SELECT CAST({smoothing} AS DOUBLE) AS smoothing, round(avg(CAST(k = label AS DOUBLE)), 6) AS f1
FROM examples JOIN first USING (doc_id) WHERE is_train = 0)"""


_SCORES = f"""{fx.LOGITS},
scores AS (SELECT vec_id, label, list_transform({fx.SQL_SOFTMAX}, lambda x: round(x, 4)) AS p FROM examples)"""
_MULTI_SCORES = f"""{fx.MULTI_LOGITS},
scores AS (SELECT vec_id, labels, list_transform(logits, lambda x: round(1 / (1 + exp(-x)), 4)) AS p FROM examples),
chosen AS (SELECT *, list_filter(range(11), lambda k: p[k + 1] > 0.5) AS above,
  list_filter(range(11), lambda k: labels[k + 1] = 1.0) AS ones FROM scores)"""
_FIRST = "list_position(p, list_max(p)) - 1"
_NAMES = """SELECT vec_id, array_to_string(list_transform(above, lambda k: 'emotion_' || CAST(k AS VARCHAR)), ',')
  AS predicted_labels FROM chosen"""
_BEST = f"""{fx.RUN_LOG}, best AS (
  SELECT run_id, epoch AS best_epoch, f1, loss FROM epochs
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY f1 DESC, epoch) = 1)"""


def _stop_sql(patience: int) -> str:
    return f"""WITH {fx.RUN_LOG},
gains AS (SELECT *, max(f1) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS before FROM epochs),
marked AS (SELECT *, before IS NULL OR f1 - before > CAST(0.005 AS DOUBLE) AS gained FROM gains),
streaks AS (SELECT *, sum(CAST(gained AS INTEGER)) OVER (PARTITION BY run_id ORDER BY epoch) AS streak FROM marked),
waits AS (SELECT *, row_number() OVER (PARTITION BY run_id, streak ORDER BY epoch) - 1 AS waited FROM streaks)
SELECT run_id, min(epoch) FILTER (WHERE waited >= {patience}) AS stop_epoch FROM waits GROUP BY run_id"""


def _indices(expression: str) -> str:
    return f"array_to_string({expression}, ',')"


def _flag_names(expression: str) -> str:
    return f"array_to_string(list_transform({expression}, lambda k: ['quality', 'toxic'][k + 1]), ',')"


_SENTIMENT_EXAMPLES = """examples AS (
  SELECT d.doc_id, d.text, CAST(l.quality AS BIGINT) AS label, CAST(d.doc_id % 5 <> 0 AS INTEGER) AS is_train
  FROM documents d JOIN labels l USING (doc_id))"""

_EPOCH_ROWS = f"""{fx.LANG}, classes AS (SELECT label FROM langs),
pieces AS (SELECT doc_id, is_train, unnest({fx.TOKENS}) AS token FROM examples),
known AS (SELECT DISTINCT token FROM pieces WHERE is_train = 1),
entries AS (
  SELECT doc_id, is_train, token, count(*) AS n FROM pieces JOIN known USING (token) GROUP BY ALL
  UNION ALL SELECT doc_id, is_train, '', 1 FROM examples),
truth AS (SELECT doc_id, is_train, classes.label AS k, CAST(e.label = classes.label AS DOUBLE) AS y FROM examples e CROSS JOIN classes),
size AS (SELECT CAST(count(*) AS DOUBLE) AS rows, (SELECT CAST(count(*) AS DOUBLE) FROM classes) AS outputs FROM examples WHERE is_train = 1),
g1 AS (
  SELECT token, k, sum(n * (1.0 / outputs - y)) / any_value(rows) AS g
  FROM entries e JOIN truth t USING (doc_id) CROSS JOIN size WHERE e.is_train = 1 GROUP BY token, k)"""


def _epochs_sql(run: str, rate: float, decay: float, epochs: int = 10) -> str:
    """Loss and f1 of the first two steps with this rate and decay; needs the tables of _EPOCH_ROWS."""

    def scores(weights: str) -> str:
        return f"SELECT doc_id, k, sum(n * w) AS x FROM entries JOIN {weights} USING (token) GROUP BY doc_id, k"

    def f1(table: str) -> str:
        return f"""SELECT avg(y) AS a FROM truth JOIN (SELECT doc_id, arg_max(k, (x, -k)) AS k FROM {table} GROUP BY doc_id)
  USING (doc_id, k) WHERE is_train = 0"""

    later = rate * (1 - 1 / epochs)
    return f"""(WITH w1 AS (SELECT token, k, -{rate} * g / (abs(g) + 1e-8) AS w, 0.1 * g AS m, 0.001 * g * g AS v FROM g1),
x1 AS ({scores("w1")}),
p AS (
  SELECT doc_id, k, y, is_train, e / sum(e) OVER (PARTITION BY doc_id) AS p
  FROM (SELECT *, exp(x - max(x) OVER (PARTITION BY doc_id)) AS e FROM x1 JOIN truth USING (doc_id, k))),
g2 AS (
  SELECT token, k, sum(n * (p - y)) / any_value(rows) AS g
  FROM entries e JOIN p USING (doc_id) CROSS JOIN size WHERE e.is_train = 1 GROUP BY token, k),
w2 AS (
  SELECT token, k, w * (1 - {later} * {decay}) - {later} * ((0.9 * m + 0.1 * g) / (1 - 0.81))
    / (sqrt((0.999 * v + 0.001 * g * g) / (1 - 0.998001)) + 1e-8) AS w FROM w1 JOIN g2 USING (token, k)),
x2 AS ({scores("w2")})
SELECT '{run}' AS run_id, CAST(1 AS DOUBLE) AS epoch, 'loss' AS metric, round((SELECT ln(outputs) FROM size), 5) AS value
UNION ALL SELECT '{run}', 2, 'loss', round((SELECT -avg(ln(p)) FROM p WHERE is_train = 1 AND y = 1), 5)
UNION ALL SELECT '{run}', 1, 'f1', round((SELECT a FROM ({f1("x1")})), 5)
UNION ALL SELECT '{run}', 2, 'f1', round((SELECT a FROM ({f1("x2")})), 5))"""


ORACLES = {
    "train_single_label": f"WITH {LANG_MODEL} {_WEIGHTS}",
    "train_multi_label": f"WITH {FLAG_MODEL} {_WEIGHTS}",
    "grid_runs": 'SELECT smoothing, f1, f1 AS "precision", f1 AS recall FROM ('
    + " UNION ALL ".join(f"SELECT * FROM {_hits_sql(s)}" for s in SMOOTHINGS)
    + ")",
    "best_epoch_metrics": f"""WITH {_BEST}
SELECT run_id, unnest(['loss', 'step', 'f1', 'best_model_epoch']) AS metric,
  unnest([loss, best_epoch * 100, round(f1, 4), best_epoch]) AS value FROM best""",
    "best_checkpoint": f"WITH {_BEST} SELECT run_id, best_epoch, f1 FROM best",
    "early_stop_epoch": _stop_sql(1),
    "early_stop_epoch_patience_3": _stop_sql(3),
    "best_run": f"""WITH {_BEST},
marked AS (SELECT *, CASE WHEN CAST(split_part(run_id, '_', 2) AS INTEGER) % 2 = 0 THEN 'even' ELSE 'odd' END AS dataset FROM best)
SELECT dataset, run_id, f1 FROM marked
QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY f1 DESC, run_id) = 1""",
    "batch_score": f"""WITH {_LANG_SCORED}
SELECT doc_id, is_train, {fx.sql_decimals('p')} AS probabilities FROM examples JOIN scored USING (doc_id)""",
    "activation": f"""WITH {fx.LOGITS},
lists AS (
  SELECT vec_id, 'softmax' AS function, {fx.SQL_SOFTMAX} AS p FROM examples
  UNION ALL SELECT vec_id, 'sigmoid', list_transform(logits, lambda x: 1 / (1 + exp(-x))) FROM examples
  UNION ALL SELECT vec_id, 'none', logits FROM examples)
SELECT vec_id, function, output, round(p, 6) AS p FROM (
  SELECT vec_id, function, unnest(p) AS p, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS output FROM lists)""",
    "round_scores": f"WITH {_SCORES} SELECT vec_id, {fx.sql_decimals('p')} AS probabilities FROM scores",
    "predicted_probability": f"WITH {_SCORES} SELECT vec_id, list_max(p) AS predicted_probability FROM scores",
    "predicted_label_index": f"WITH {_SCORES} SELECT vec_id, CAST({_FIRST} AS INTEGER) AS predicted_label_indx FROM scores",
    "predicted_label": f"""WITH {_SCORES}
SELECT vec_id, label AS label_indx, CAST({_FIRST} AS INTEGER) AS predicted_label_indx,
  'label_' || CAST({_FIRST} AS VARCHAR) AS predicted_label, 'label_' || CAST(label AS VARCHAR) AS label FROM scores""",
    "threshold_indices": f"WITH {_MULTI_SCORES} SELECT vec_id, {_indices('above')} AS predicted_label_indxs FROM chosen",
    "true_indices": f"WITH {_MULTI_SCORES} SELECT vec_id, {_indices('ones')} AS label_indxs FROM chosen",
    "index_names": f"WITH {_MULTI_SCORES} {_NAMES}",
    "index_names_by_key": f"WITH {_MULTI_SCORES} {_NAMES}",
    "single_label_predictions": f"""WITH {_LANG_SCORED}
SELECT doc_id, text, CAST(e.label AS INTEGER) AS label_indx, is_train, {fx.sql_decimals('p')} AS probabilities,
  printf('%.4f', list_max(p)) AS predicted_probability, CAST({_FIRST} AS INTEGER) AS predicted_label_indx,
  l.lang AS predicted_label, e.lang AS label
FROM examples e JOIN scored USING (doc_id) JOIN langs l ON l.label = {_FIRST}""",
    "multi_label_predictions": f"""WITH {FLAG_MODEL}, {scored_sql('doc_id')},
probs AS (SELECT doc_id, list(round(1 / (1 + exp(-x)), 4) ORDER BY output) AS p FROM raw GROUP BY doc_id),
chosen AS (SELECT *, list_filter(range(2), lambda k: p[k + 1] > 0.5) AS above,
  list_filter(range(2), lambda k: labels[k + 1] = 1.0) AS ones FROM examples JOIN probs USING (doc_id))
SELECT doc_id, text, {fx.sql_decimals('labels')} AS all_label_indxs, is_train,
  {fx.sql_decimals('p')} AS pred_proba_label_indxs, {_indices('above')} AS predicted_label_indxs,
  {_flag_names('above')} AS predicted_labels, {_indices('ones')} AS label_indxs, {_flag_names('ones')} AS labels
FROM chosen""",
    "sentiment_score": f"""WITH {_single_sql(_SENTIMENT_EXAMPLES, "SELECT range AS label FROM range(2)")},
texts AS (
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS key, text FROM documents
  UNION ALL SELECT 'turn-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text FROM conversations),
{scored_sql('key', 'texts')}
SELECT key, ['NEGATIVE', 'POSITIVE'][{_FIRST} + 1] AS label_name, printf('%.4f', list_max(p)) AS score FROM scored""",
}
ORACLES["batch_score_plug_in"] = """SELECT doc_id,
  printf('%.4f', (length(text) % 10) / 10) || ',' || printf('%.4f', 1 - (length(text) % 10) / 10) AS probabilities
FROM documents"""
ORACLES["batch_score_by_key"] = ORACLES["batch_score"]
ORACLES["run_metrics"] = f"""WITH {_LANG_SCORED},
judged AS (SELECT is_train, e.label = {_FIRST} AS hit FROM examples e JOIN scored USING (doc_id)),
found AS (
  SELECT round(avg(CAST(hit AS DOUBLE)) FILTER (WHERE is_train = 0), 4) AS f1,
    CAST(count(*) FILTER (WHERE is_train = 1) AS DOUBLE) AS train_rows, CAST(count(*) FILTER (WHERE is_train = 0) AS DOUBLE) AS eval_rows
  FROM judged)
SELECT 'nb' AS run_id, unnest(['f1', 'train_rows', 'eval_rows']) AS metric, unnest([f1, train_rows, eval_rows]) AS value FROM found"""
ORACLES["epoch_grid"] = f"WITH {_EPOCH_ROWS} " + " UNION ALL ".join(
    f"SELECT * FROM {_epochs_sql(name, rate, decay, 2)}" for name, (rate, decay) in EPOCH_GRID.items()
)
ORACLES["train_epochs_by_parts"] = f"WITH {_EPOCH_ROWS} SELECT * FROM {_epochs_sql('plain', 0.02, 0.01, 2)}"
