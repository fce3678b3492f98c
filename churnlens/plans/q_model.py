"""Model queries: combined features, search, importances, scoring, metrics."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from churnlens.operators import onehot
from churnlens.plans import dashboard as dash
from churnlens.plans import model as mdl
from churnlens.plans.q_graph import (_GF_CTES, _GF_SQL, LP_ROUNDS_FEATURES,
                                     PAGERANK_ROUNDS)
from churnlens.plans.q_relational import (FEATURES_SQL, SILVER_SQL, customer_facts,
                                          input_path, run_path, silver)
from churnlens.plans.queries import r4, r11, register, rounded, rounded_fine
from churnlens.session import scratch_path
from churnlens.sources import fixtures as fx
from churnlens.sources import ingest
from churnlens.sources.fixtures import with_views

#: (application, checksum of the inputs, what) -> what was made of them. The
#: key is the content, so changed input never meets older results.
_WRITTEN: dict = {}


def forget_written() -> None:
    """Compute the next query's tables and models anew (for measurements)."""
    _WRITTEN.clear()


def _key(spark, sf_dir):
    tables = (fx.subscribers(spark, sf_dir), fx.call_log(spark, sf_dir))
    sums = [t.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*t.columns).cast("decimal(20,0)"))).first() for t in tables]
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir), str(sums))


def vocabulary(spark, sf_dir):
    return onehot.collect_vocabulary(silver(spark, sf_dir).drop("mobile_number"))


def _graph_features(spark, sf_dir, key):
    """The graph features of all customers. Their rounds, whose states are stored,
    run once for the same input rows; what joins them is left to the reader."""
    from churnlens.plans import graph_features as gf
    k = (*key, "graph", id(spark))
    if k not in _WRITTEN:
        _WRITTEN[k] = gf.graph_features(silver(spark, sf_dir), fx.edges(spark, sf_dir),
                                        pagerank_iter=PAGERANK_ROUNDS, label_iter=LP_ROUNDS_FEATURES)
    return _WRITTEN[k]


def combined_features(spark, sf_dir, key=None):
    """Customer features inner-joined to graph features on customer_id, as a
    Parquet feature table; written once for the same input rows."""
    key = key or _key(spark, sf_dir)
    k = (*key, "combined")
    if k not in _WRITTEN:
        customers = silver(spark, sf_dir)
        g = _graph_features(spark, sf_dir, key)
        vocab = vocabulary(spark, sf_dir)
        c = onehot.customer_features(customers.drop("mobile_number"), vocab).join(g, "customer_id", "inner")
        path = scratch_path(spark, f"features/combined_{run_path(sf_dir)}")
        c.write.mode("overwrite").parquet(path)
        mdl.save_vocabulary(spark, vocab, path)
        _WRITTEN[k] = path
    return spark.read.parquet(_WRITTEN[k])


def search_result(spark, sf_dir, key=None):
    """The search over all candidates, with the model and its vocabulary saved.
    Its trials are added to the input's history, which all runs over it share."""
    key = key or _key(spark, sf_dir)
    k = (*key, "search")
    if k not in _WRITTEN:
        data = combined_features(spark, sf_dir, key)
        res = mdl.search_halving(data)
        root = scratch_path(spark, f"models/{input_path(sf_dir)}")
        path = mdl.save_model(res.best_model, f"{root}/{res.run_id}")
        mdl.save_vocabulary(spark, mdl.load_vocabulary(spark, _WRITTEN[(*key, "combined")]), path)
        mdl.append_trials(mdl.trials_frame(spark, res), f"{root}/trials")  # after the model, so the history names none that is missing
        _WRITTEN[k] = (res, root, path)
    return _WRITTEN[k]


_GF_CTE_BODY = _GF_SQL
_COMBINED_SQL = with_views(
    "SELECT f.* REPLACE (" + ", ".join(f"{r4('f.' + c)} AS {c}" for c in ("monthly_charges", "total_charges"))
    + "), g.* EXCLUDE (customer_id) FROM features f JOIN GF g ON g.customer_id = f.customer_id",
    ["subscribers", "edges"],
    [("silver", SILVER_SQL), ("features", FEATURES_SQL)] + _GF_CTES + [("GF", _GF_CTE_BODY)])


@register("combined_features", _COMBINED_SQL)
def q_combined_features(spark, sf_dir):
    return rounded(combined_features(spark, sf_dir))


@register("trials")
def q_trials(spark, sf_dir):
    """Model-search trial records (rows-only: metrics depend on the fit)."""
    res, _, _ = search_result(spark, sf_dir)
    return mdl.trials_frame(spark, res)


@register("gold_flow")
def q_gold_flow(spark, sf_dir):
    """Saved model and vocabulary -> features of all customers -> scores ->
    dashboard rows -> saved gold table -> CSV, read back (rows-only)."""
    key = _key(spark, sf_dir)
    _, _, path = search_result(spark, sf_dir, key)
    customers, g = silver(spark, sf_dir), _graph_features(spark, sf_dir, key)
    features = onehot.customer_features(customers.drop("mobile_number"), mdl.load_vocabulary(spark, path)).join(g, "customer_id")
    scored = mdl.score(mdl.load_best_model(path), features)
    run = run_path(sf_dir)
    ingest.ensure_schema(spark, "churnlens")
    name = f"churnlens.gold_{run}"
    ingest.write_table(dash.dashboard_rows(scored, customer_facts(spark, sf_dir)), name, scratch_path(spark, f"tables/{name}"))
    gold = ingest.read_table(spark, name)
    csv = scratch_path(spark, f"gold_csv/{run}")
    ingest.write_csv(gold, csv, {"probability": 2})
    flat = gold.select(*[c for f in gold.columns for c in (
        [F.get(f, F.lit(i)).alias(f"{f}_{i}") for i in (0, 1)] if f == "probability" else [F.col(f)])])
    return ingest.read_csv(spark, csv, flat.schema)


@register("model_result")
def q_model_result(spark, sf_dir):
    res, _, path = search_result(spark, sf_dir)
    return mdl.result_record(spark, res, path)


@register("best_trial")
def q_best_trial(spark, sf_dir):
    """The best trial of the newest run in the input's history."""
    _, root, _ = search_result(spark, sf_dir)
    return mdl.best_trial(mdl.read_trials(spark, f"{root}/trials"))


@register("trial_history")
def q_trial_history(spark, sf_dir):
    """Runs over this input, newest first: a second, smaller search follows the
    first, and its best trial is then the newest (rows-only)."""
    _, root, _ = search_result(spark, sf_dir)
    data = combined_features(spark, sf_dir)
    again = mdl.search_halving(data, candidates=mdl.default_candidates()[:3], rungs=1)
    mdl.save_model(again.best_model, f"{root}/{again.run_id}")
    return mdl.run_history(mdl.append_trials(mdl.trials_frame(spark, again), f"{root}/trials"))


@register("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    """Rise of the held-out log loss when a feature is permuted (rows-only)."""
    res, _, _ = search_result(spark, sf_dir)
    return mdl.permutation_importance(res.best_model, res.features, mdl.held_out(combined_features(spark, sf_dir)))


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Importances of the best model, largest first (rows-only)."""
    res, _, _ = search_result(spark, sf_dir)
    return mdl.feature_importance(res.best_model, res.features, combined_features(spark, sf_dir))


@register("score_customers")
def q_score_customers(spark, sf_dir):
    """Best model loaded from storage and applied to every customer."""
    res, root, path = search_result(spark, sf_dir)
    model = mdl.load_best_model(path, None, mdl.trials_frame(spark, res), root)
    return mdl.score(model, combined_features(spark, sf_dir))


_SCORED_SQL = with_views(
    "SELECT f.churn, s.prediction, s.p_churn FROM scores s JOIN features f ON f.customer_id = s.customer_id",
    ["subscribers", "scores"], [("silver", SILVER_SQL), ("features", FEATURES_SQL)])


def _scored(spark, sf_dir):
    return fx.scores(spark, sf_dir).join(customer_facts(spark, sf_dir).select("customer_id", "churn"),
                                         "customer_id")


@register("confusion_counts", _SCORED_SQL.replace(
    "SELECT f.churn, s.prediction, s.p_churn FROM", "SELECT f.churn AS label, s.prediction, count(*) AS count FROM")
    + " GROUP BY f.churn, s.prediction")
def q_confusion_counts(spark, sf_dir):
    return mdl.confusion_counts(_scored(spark, sf_dir))


@register("confusion_metrics", _SCORED_SQL.replace(
    "SELECT f.churn, s.prediction, s.p_churn FROM",
    "SELECT " + ", ".join([
        f"{r4('count(*) FILTER (WHERE f.churn = s.prediction) / CAST(count(*) AS DOUBLE)')} AS accuracy",
        f"{r4('CAST(count(*) FILTER (WHERE f.churn = 1 AND s.prediction = 1) AS DOUBLE) / count(*) FILTER (WHERE s.prediction = 1)')} AS precision",
        f"{r4('CAST(count(*) FILTER (WHERE f.churn = 1 AND s.prediction = 1) AS DOUBLE) / count(*) FILTER (WHERE f.churn = 1)')} AS recall",
    ]) + ", " + r4(
        "2.0 * (CAST(count(*) FILTER (WHERE f.churn = 1 AND s.prediction = 1) AS DOUBLE) / count(*) FILTER (WHERE s.prediction = 1))"
        " * (CAST(count(*) FILTER (WHERE f.churn = 1 AND s.prediction = 1) AS DOUBLE) / count(*) FILTER (WHERE f.churn = 1))"
        " / ((CAST(count(*) FILTER (WHERE f.churn = 1 AND s.prediction = 1) AS DOUBLE) / count(*) FILTER (WHERE s.prediction = 1))"
        " + (CAST(count(*) FILTER (WHERE f.churn = 1 AND s.prediction = 1) AS DOUBLE) / count(*) FILTER (WHERE f.churn = 1)))")
    + " AS f1, " + r11("avg(-ln(least(greatest(CASE WHEN f.churn = 1 THEN s.p_churn ELSE 1.0 - s.p_churn END, 1e-15), 1 - 1e-15)))")
    + " AS log_loss FROM"))
def q_confusion_metrics(spark, sf_dir):
    return rounded_fine(mdl.classification_metrics(_scored(spark, sf_dir), probability="p_churn"), ["log_loss"])
