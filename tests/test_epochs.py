"""Training in epochs."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx, flows
from lexiloom.config import MULTI_LABEL, SINGLE_LABEL
from lexiloom.operators import runs as rn
from lexiloom.operators import epochs
from lexiloom.operators.epochs import Setting, train_epoch_grid, train_epochs
from lexiloom.operators.evaluate import metrics_for
from lexiloom.operators.score import add_logits
from lexiloom.operators.staging import SCRATCH, Scratch
from lexiloom.operators.vocabulary import build_vocabulary

SF = "/root/testdata/sf0.001"


def values(log, metric):
    return [r.value for r in log.where(F.col("metric") == metric).orderBy("epoch").collect()]


@pytest.mark.parametrize("problem", [SINGLE_LABEL, MULTI_LABEL])
def test_epochs(spark, problem):
    multi = problem == MULTI_LABEL
    examples = fx.flag_examples(spark, SF) if multi else fx.lang_examples(spark, SF)[0]
    train, test = fx.train_test(examples) if not multi else (
        examples.where("doc_id % 5 <> 0"), examples.where("doc_id % 5 = 0"))
    outputs = 2 if multi else 4
    vocabulary = build_vocabulary(train, 3000)
    run = train_epochs(train, test, vocabulary, outputs, problem, max_epochs=4)
    losses, f1s = values(run.log, "loss"), values(run.log, "f1")
    assert len(losses) == len(f1s) <= 4 and losses[-1] < losses[0]
    assert max(f1s) > 0.6
    # The operators on the log agree with what the training did.
    best = rn.best_checkpoint(run.log).first()
    assert best.f1 == max(f1s) and best.best_epoch == f1s.index(max(f1s)) + 1
    stop = rn.early_stop_epoch(run.log).first().stop_epoch
    assert stop in (None, float(len(f1s)))
    told = {r.metric: r.value for r in rn.best_epoch_metrics(run.log).collect()}
    assert told["best_model_epoch"] == best.best_epoch and told["f1"] == round(best.f1, 4) and "eval_runtime" not in told
    # The kept model gives the metrics of its epoch, through the ordinary scoring.
    again = metrics_for(add_logits(test, run.model), problem).first()
    assert again.f1 == pytest.approx(best.f1)


def test_first_loss_is_that_of_a_fresh_model(spark):
    import math

    df = spark.createDataFrame([(1, "a b", 0), (2, "c", 1)], "doc_id long, text string, label long")
    run = train_epochs(df, df, build_vocabulary(df, 10), 2, SINGLE_LABEL, max_epochs=2, patience=5)
    assert values(run.log, "loss")[0] == pytest.approx(math.log(2))
    assert values(run.log, "f1") == [1.0, 1.0]


@pytest.mark.parametrize("problem", [SINGLE_LABEL, MULTI_LABEL])
def test_weights_above_the_limit_are_joined(spark, problem):
    rows = [(i, None if i == 7 else f"a {'b c' if i % 2 else 'd a'} w{i % 11}", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label long")
    if problem == MULTI_LABEL:
        df = df.select("doc_id", "text", F.array(F.col("label").cast("float"), F.lit(1.0).cast("float")).alias("labels"))
    df = df.where("text is not null")
    vocabulary = build_vocabulary(df, None)
    runs = [train_epochs(df, df, vocabulary, 2, problem, max_epochs=3, limit=limit) for limit in (1 << 26, 0)]
    for metric in ("loss", "f1"):
        assert values(runs[1].log, metric) == pytest.approx(values(runs[0].log, metric))
    found = [{r.token: r.weights for r in run.model.weights.collect()} for run in runs]
    assert found[0].keys() == found[1].keys() and len(found[0]) == 16
    assert all(found[1][token] == pytest.approx(found[0][token]) for token in found[0])


@pytest.mark.parametrize("limit", [1 << 26, 20_000])
def test_models_side_by_side_equal_single_runs(spark, limit):
    """Different rates, decays and patience; one of them stops before the others."""
    train, test = fx.train_test(fx.lang_examples(spark, SF)[0])
    vocabulary = build_vocabulary(train, None)
    settings = {"a": Setting(0.02, 0.01, 1), "b": Setting(0.5, 0.0, 2), "c d/e": Setting(0.001, 0.9, 9)}
    together = train_epoch_grid(train, test, vocabulary, 4, SINGLE_LABEL, settings, max_epochs=4, limit=limit)
    lengths = set()
    for name, setting in settings.items():
        alone = train_epochs(train, test, vocabulary, 4, SINGLE_LABEL, name, 4, *setting, limit=limit)
        for metric in ("loss", "f1", "learning_rate"):
            assert values(together[name].log, metric) == pytest.approx(values(alone.log, metric), rel=1e-9)
        lengths.add(len(values(alone.log, "loss")))
        one, two = ({r.token: r.weights for r in run.model.weights.collect()} for run in (together[name], alone))
        assert one.keys() == two.keys() and all(one[t] == pytest.approx(two[t], rel=1e-6, abs=1e-9) for t in one)
    assert len(lengths) > 1


def test_no_token_moves_after_the_first_epoch(spark):
    """Entries of the tail are met in their buckets: what moves are sums per text and per id."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    train, _ = fx.train_test(fx.lang_examples(spark, SF)[0])
    vocabulary = build_vocabulary(train, None)
    scratch = Scratch(spark)
    head = epochs._head_size(vocabulary, 4, 20_000)
    assert head < vocabulary.count()
    rows = epochs._encoded(train, vocabulary, "label", head, scratch)
    blank = F.array_repeat(F.lit(0.0), 4)
    buckets = spark.sparkContext.defaultParallelism
    state = scratch.keep(vocabulary.select("id", blank.alias("w"), blank.alias("m"), blank.alias("v")), "id", buckets)
    scored = epochs._scored(rows, state, 4, head)

    def moves(df):
        """Keys by which rows are exchanged outside of subqueries, which only pack the head."""
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        main = out.getvalue().split("===== Subqueries")[0]
        return re.findall(r"Arguments: hashpartitioning\((\w+)#", main) + ["all"] * main.count("BroadcastExchange (")

    # The only exchange is that of the sums per text; the next one is that of the sums per id.
    assert moves(scored) == ["row"]
    gradients = epochs._gradients(scored, "label", 4, 1, SINGLE_LABEL)
    assert sorted(moves(gradients)) == ["id", "row"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Every token of every text is there once, in the head or in the tail.
    known = rows.rows.selectExpr("size(ids) - 1 + aggregate(tail, 0L, (a, x) -> a + x.n) as n").agg(F.sum("n")).first()[0]
    assert known == train.selectExpr("size(array_remove(split(lower(text), ' '), '')) as n").agg(F.sum("n")).first()[0]
    scratch.close()


def test_files_of_a_run_are_deleted(spark):
    df = spark.createDataFrame([(1, "a b", 0), (2, "c", 1)], "doc_id long, text string, label long")
    before = {r.tableName for r in spark.sql(f"SHOW TABLES IN {SCRATCH}").collect()}
    run = train_epochs(df, df, build_vocabulary(df, 10), 2, SINGLE_LABEL, max_epochs=2, patience=5, limit=0)
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {SCRATCH}").collect()} == before
    assert run.model.weights.count() == 4


def test_texts_and_labels_without_an_id(spark):
    df = spark.createDataFrame([("a b", 0), ("c", 1), ("a b", 0), (None, 1)], "text string, label long")
    found = [train_epochs(df, df, build_vocabulary(df, None), 2, SINGLE_LABEL, max_epochs=2, patience=5, limit=n) for n in (1 << 26, 0)]
    assert values(found[0].log, "loss") == pytest.approx(values(found[1].log, "loss"))


def test_the_query_trains_on_all_tokens(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(flows, "build_vocabulary", lambda train, size: asked.append(size) or build_vocabulary(train, size))
    flows.train_epochs(spark, SF)
    assert asked == [None]


def test_all_tables_lie_in_equal_buckets_and_states_are_not_dealt_again(spark, monkeypatch):
    kept = []
    keep = Scratch.keep

    def noting(self, df, key=None, buckets=0, placed=False):
        kept.append((key, buckets, placed))
        return keep(self, df, key, buckets, placed)

    monkeypatch.setattr(Scratch, "keep", noting)
    # Many more tokens for evaluation than for training.
    df = spark.createDataFrame([("a b b", 0), ("c", 1)], "text string, label long")
    more = spark.createDataFrame([(" ".join(f"w{i}" for i in range(5_000)) + " a", 0)], "text string, label long")
    monkeypatch.setattr(epochs, "BUCKET_BYTES", 2_000)
    train_epochs(df, more, build_vocabulary(df, None), 2, SINGLE_LABEL, max_epochs=2, patience=5, limit=0)
    assert len({buckets for key, buckets, _ in kept if key}) == 1
    # The blank state, then one of each epoch.
    assert [placed for *_, placed in kept[-3:]] == [False, True, True]
