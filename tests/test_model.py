"""Model search quality: the best held-out log loss beats the constant
predictor (the training churn rate) on the same fixed-seed split."""

import math
import os

import pytest
from pyspark.sql import functions as F

from churnlens.operators import onehot
from churnlens.plans import model as mdl
from churnlens.plans import queries  # noqa: F401  (registers the query modules)
from churnlens.plans.q_relational import customer_features, silver

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_search_beats_constant_predictor(spark):
    df = customer_features(spark, SF)
    some = mdl.default_candidates()
    res = mdl.search(df, candidates=[some[0], some[3], some[7]], max_trials=2, seed=42)
    assert [t["trial"] for t in res.trials] == [0, 1, 2]
    assert [t.get("skipped") for t in res.trials] == [None, None, "max_trials"]
    fold = F.pmod(F.xxhash64("customer_id", F.lit(42)), F.lit(10_000)) < 8000
    p = df.where(fold).agg(F.avg("churn")).first()[0]
    y = F.col("churn")
    constant = df.where(~fold).agg(F.avg(-(y * F.lit(math.log(p)) + (1 - y) * F.lit(math.log(1 - p))))).first()[0]
    assert res.best["log_loss"] < constant
    trials = mdl.trials_frame(spark, res)
    assert trials.count() == 3
    assert mdl.best_trial(trials).first()["log_loss"] == pytest.approx(res.best["log_loss"])


def test_metrics_match_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    rows = [(float(i % 2), float(i % 3 == 0), [1 - (i % 10) / 10, (i % 10) / 10]) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, prediction double, p array<double>").withColumn("probability", array_to_vector("p"))
    got = mdl._metrics(df)
    ev = MulticlassClassificationEvaluator(metricLabel=1.0)
    for name, metric in (("log_loss", "logLoss"), ("accuracy", "accuracy"), ("precision", "precisionByLabel"),
                         ("recall", "recallByLabel"), ("f1", "fMeasureByLabel")):
        assert got[name] == pytest.approx(ev.setMetricName(metric).evaluate(df), rel=1e-9)


def test_split_does_not_depend_on_storage(spark):
    df = customer_features(spark, "/root/testdata/sf0.001")
    one = mdl.default_candidates()[:1]
    a, b = (mdl.search(x, candidates=one).best["log_loss"] for x in (df, df.repartition(7)))
    assert a == pytest.approx(b, rel=1e-6)


def test_vocabulary_and_history_are_kept(spark, tmp_path):
    vocab = onehot.collect_vocabulary(silver(spark, "/root/testdata/sf0.001"))
    mdl.save_vocabulary(spark, {**vocab, "unused": []}, str(tmp_path / "model"))
    assert mdl.load_vocabulary(spark, str(tmp_path / "model")) == {**vocab, "unused": []}
    schema = ("run_id string, created double, trial int, algorithm string, params string, log_loss double, accuracy double, "
              "precision double, recall double, f1 double, duration_s double, skipped string")
    runs = [("old", 1.0, 0, "a", "", 0.1, *[0.0] * 5, None), ("new", 2.0, 0, "a", "", 0.4, *[0.0] * 5, None),
            ("new", 2.0, 1, "a", "", 0.3, *[0.0] * 5, None), ("new", 2.0, 2, "a", "", None, *[None] * 5, "timeout")]
    for r in runs:
        history = mdl.append_trials(spark.createDataFrame([r], schema), str(tmp_path / "trials"))
    assert history.count() == 4
    assert (mdl.best_trial(history).first().run_id, mdl.best_trial(history).first().trial) == ("new", 1)


def test_unreadable_model_is_an_error(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception):
        mdl.load_best_model(str(tmp_path / "broken"), str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError):
        mdl.load_best_model(str(tmp_path / "absent"))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_halving_finds_the_winner_of_the_grid(spark):
    df = customer_features(spark, SF).cache()
    some = [c for i, c in enumerate(mdl.default_candidates()) if i in (0, 1, 2, 3, 7)]
    halved, grid = mdl.search_halving(df, candidates=some), mdl.search(df, candidates=some)
    assert halved.best["trial"] == grid.best["trial"]
    assert halved.best["log_loss"] == pytest.approx(grid.best["log_loss"], rel=1e-3)
    assert [t["trial"] for t in halved.trials] == [0, 1, 2, 3, 4]
    assert {t["rung"] for t in halved.trials} == {0, 1, 2} and all(t["log_loss"] > 0 for t in halved.trials)
    assert [t.get("skipped") for t in halved.trials].count(None) == 1
    trials = mdl.trials_frame(spark, halved)
    assert mdl.best_trial(trials).first().trial == grid.best["trial"]
    test = mdl.held_out(df)
    base = mdl._metrics(halved.best_model.transform(test.withColumn("label", F.col("churn").cast("double"))))
    assert base["log_loss"] == pytest.approx(halved.best["log_loss"], rel=1e-9)  # the kept model assembles by itself


def test_permutation_importance_of_all_kinds(spark):
    rows = spark.range(1200).select(
        F.col("id").cast("string").alias("customer_id"), F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("good"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double").alias("useless"), F.lit(3.0).alias("constant"))
    rows = rows.withColumn("churn", ((F.col("good") + F.pmod(F.xxhash64("customer_id", F.lit(2)), F.lit(30))) > 60).cast("int")).cache()
    some = mdl.default_candidates()
    for candidate in (some[0], some[3], some[7]):
        res = mdl.search_halving(rows, candidates=[candidate], rungs=1)
        got = {r.feature: r.importance for r in mdl.permutation_importance(res.best_model, res.features, mdl.held_out(rows)).collect()}
        assert got["good"] > 0.3 and abs(got["useless"]) < 0.1 * got["good"] and got["constant"] == pytest.approx(0, abs=1e-9)


def test_models_score_in_a_session_that_has_observed(spark):
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = spark.range(200).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 7).cast("double").alias("x"),
                                   (F.col("id") % 7 > 3).cast("int").alias("churn")).cache()
    some = mdl.default_candidates()
    for candidate in (some[1], some[3], some[7]):
        for res in (mdl.search(rows, candidates=[candidate]), mdl.search_halving(rows, candidates=[candidate], rungs=1)):
            assert mdl.score(res.best_model, rows).count() == 200 and res.best["log_loss"] >= 0
            assert len(mdl.score(res.best_model, rows).collect()) == 200


def test_a_permutation_keeps_the_values(spark):
    from churnlens.operators.dense import positions
    df = spark.range(900).selectExpr("id % 3 AS g", "id", "id * 7919 % 1000 AS h").repartition(6)
    got = positions(df, "g", ["h", "id"]).collect()
    for g in range(3):
        mine = sorted((r for r in got if r.g == g), key=lambda r: (r.h, r.id))
        assert [r.pos for r in mine] == list(range(300))


def test_history_of_two_runs(spark, tmp_path):
    make = lambda run, created, trial, loss, skipped: (run, created, trial, "a", "{}", loss, *[0.5] * 4, 1.0, skipped, 0, 1.0)
    for rows in ([make("old", 1.0, 0, 0.2, None), make("old", 1.0, 1, 0.1, "stopped at rung 0")], [make("new", 2.0, 0, 0.4, None)]):
        history = mdl.append_trials(spark.createDataFrame(rows, mdl.TRIALS_SCHEMA), str(tmp_path / "t"))
    assert [(r.run_id, r.trials, r.best_trial, r.best_log_loss) for r in mdl.run_history(history).collect()] == [
        ("new", 1, 0, 0.4), ("old", 2, 0, 0.2)]
    assert mdl.best_trial(mdl.read_trials(spark, str(tmp_path / "t"))).first().run_id == "new"


def test_gold_flow_computes_graph_features_once(spark, tmp_path, monkeypatch):
    from churnlens.plans import graph_features as gf
    from churnlens.plans import q_model
    spark.createDataFrame([(k, k % 25, 100.0 * (k % 90) - 900, ("HOUSEHOLD", "MACHINERY", "BUILDING")[k % 3]) for k in range(120)],
                          "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, k % 120) for k in range(400)], "o_orderkey long, o_custkey long").withColumn(
        "o_orderdate", F.lit("1995-01-01 00:00:00").cast("timestamp")).write.parquet(f"{tmp_path}/orders.parquet")
    calls, real, some = [], gf.graph_features, mdl.default_candidates()[:1]
    monkeypatch.setattr(gf, "graph_features", lambda *a, **k: calls.append(1) or real(*a, **k))
    monkeypatch.setattr(mdl, "default_candidates", lambda *a: some)
    assert q_model.q_gold_flow(spark, str(tmp_path)).count() > 100
    assert calls == [1]
