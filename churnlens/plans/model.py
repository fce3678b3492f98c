"""Churn model: search, trial records, importances, persistence, scoring.

The hosted model search of the reference becomes a bounded search over
Spark ML classifiers: each trial fits a ``Pipeline`` (VectorAssembler +
classifier) on a fixed-seed training split and is scored by log loss on the
held-out split. Fitting and evaluation are distributed Spark ML jobs; only
the trial records (one row per trial) live on the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.util import inheritable_thread_target

from churnlens.operators.dense import positions
from churnlens.operators.iterate import stored

TARGET = "churn"
KEY = "customer_id"


def feature_columns(df: DataFrame, target: str = TARGET, exclude: list[str] | None = None) -> list[str]:
    """Every numeric column except the target and the excluded ones."""
    skip = {target, *(exclude or [KEY])}
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, NumericType)]


def default_candidates(seed: int = 42) -> list[tuple[str, object, dict]]:
    """(algorithm, estimator, params) in search order: cheap models first."""
    out = []
    for reg in (0.0, 0.01, 0.1):
        out.append(("logistic_regression",
                    LogisticRegression(labelCol="label", maxIter=100, regParam=reg),
                    {"regParam": reg}))
    for depth in (5, 8):
        for trees in (50, 100):
            out.append(("random_forest",
                        RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed),
                        {"numTrees": trees, "maxDepth": depth}))
    for depth in (3, 5):
        for iters in (20, 50):
            out.append(("gbt",
                        GBTClassifier(labelCol="label", maxIter=iters, maxDepth=depth, seed=seed),
                        {"maxIter": iters, "maxDepth": depth}))
    return out


@dataclass
class SearchResult:
    run_id: str
    trials: list[dict] = field(default_factory=list)
    best_model: PipelineModel | None = None
    best: dict | None = None
    features: list[str] = field(default_factory=list)
    n_rows: int = 0
    duration_s: float = 0.0
    created: float = 0.0


def _metrics(pred: DataFrame) -> dict:
    """Log loss and the confusion metrics from one aggregate over the scored rows."""
    p1 = F.get(vector_to_array("probability"), F.lit(1))
    return classification_metrics(pred.select(F.col("label").cast("int").alias(TARGET),
                                              F.col("prediction").cast("int").alias("prediction"), p1.alias("p1")),
                                  probability="p1").first().asDict()


def _fitted(model):
    """``model`` without the summary of its training, which refers to the whole
    session: what scores rows is sent to the tasks with all it refers to, and a
    session that has observed metrics once can't be sent."""
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            stage._call_java("setSummary", SparkSession.active()._jvm.scala.Option.empty())
    return model


def search(df: DataFrame, target: str = TARGET, exclude: list[str] | None = None,
           max_trials: int = 20, timeout_s: float = 1800.0, seed: int = 42,
           candidates: list | None = None, train_fraction: float = 0.8) -> SearchResult:
    """Fit up to ``max_trials`` candidates within ``timeout_s`` seconds and
    keep the one with the lowest held-out log loss.

    The time limit is checked between trials (a trial is never cut short); a
    candidate that either limit leaves out is recorded as a skipped trial. The
    split is by the hash of key and seed, so it does not depend on how the
    rows are stored; it is cached once and shared by every trial.
    """
    started = time.time()
    feats = feature_columns(df, target, exclude)
    data = df.withColumn("label", F.col(target).cast("double"))
    fold = F.pmod(F.xxhash64(KEY, F.lit(seed)), F.lit(10_000)) < int(train_fraction * 10_000)
    train, test = data.where(fold).cache(), data.where(~fold).cache()
    res = SearchResult(run_id=uuid.uuid4().hex[:12], features=feats, n_rows=df.count(),
                       created=started)
    assembler = VectorAssembler(inputCols=feats, outputCol="features")
    for i, (algo, est, params) in enumerate(candidates or default_candidates(seed)):
        given = {"trial": i, "algorithm": algo, "params": json.dumps(params, sort_keys=True)}
        reason = "max_trials" if i >= max_trials else "timeout" if time.time() - started > timeout_s else None
        if reason:
            res.trials.append({**given, "skipped": reason})
            continue
        t0 = time.time()
        model = _fitted(Pipeline(stages=[assembler, est]).fit(train))
        m = _metrics(model.transform(test))
        trial = {**given, **m, "duration_s": time.time() - t0}
        res.trials.append(trial)
        if res.best is None or m["log_loss"] < res.best["log_loss"]:
            res.best, res.best_model = trial, model
    train.unpersist()
    test.unpersist()
    res.duration_s = time.time() - started
    return res


def search_halving(df: DataFrame, target: str = TARGET, exclude: list[str] | None = None, eta: int = 3, rungs: int = 3,
                   parallel: int = 4, seed: int = 42, candidates: list | None = None, train_fraction: float = 0.8) -> SearchResult:
    """Successive halving: all candidates are fitted on a small sample of the
    training rows, the best 1 / ``eta`` of them by held-out log loss on ``eta``
    times the rows, and so on to the last rung, which trains on all of them.

    Samples are nested and chosen by the hash of key and seed; the held-out rows
    are those of ``search``, and all of them are scored on every rung. The trials
    of a rung run side by side, each in a scheduler pool of its own (with
    ``spark.scheduler.mode`` FAIR they share the cluster evenly). A trial that
    ends on an early rung is recorded with its metrics and where it stopped.
    """
    started = time.time()
    feats = feature_columns(df, target, exclude)
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    place = F.pmod(F.xxhash64(KEY, F.lit(seed)), F.lit(10_000))
    cut = int(train_fraction * 10_000)
    # assembled once, not once a trial
    data = VectorAssembler(inputCols=feats, outputCol="features").transform(
        df.select(KEY, *feats, F.col(target).cast("double").alias("label"))).select(KEY, "features", "label", place.alias("place")).cache()
    test = data.where(F.col("place") >= cut)
    res = SearchResult(run_id=uuid.uuid4().hex[:12], features=feats, n_rows=data.count(), created=started)
    left = list(enumerate(candidates or default_candidates(seed)))
    inner = F.pmod(F.xxhash64(F.lit("rung"), KEY, F.lit(seed)), F.lit(1 << 20))

    def fit(i, given, est, train):
        sc.setLocalProperty("spark.scheduler.pool", f"trial-{i}")
        t0 = time.time()
        model = _fitted(est.fit(train))
        return i, model, {**given, **_metrics(model.transform(test)), "duration_s": time.time() - t0}

    for rung in range(rungs):
        last = rung == rungs - 1
        share = 1.0 if last else float(eta) ** (rung - rungs + 1)
        train = data.where((F.col("place") < cut) & (inner < int(share * (1 << 20))))
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            # the longest trials come last in the list and start first, so none runs on alone
            runs = [pool.submit(inheritable_thread_target(spark)(fit), i,
                                {"trial": i, "algorithm": algo, "params": json.dumps(params, sort_keys=True), "rung": rung, "train_share": share},
                                est, train) for i, (algo, est, params) in reversed(left)]
            done = sorted((r.result() for r in runs), key=lambda x: (x[2]["log_loss"], x[0]))
        keep = len(done) if last else max(1, -(-len(done) // eta))
        for k, (i, model, trial) in enumerate(done):
            if last:
                res.trials.append(trial)
            elif k >= keep:
                res.trials.append({**trial, "skipped": f"stopped at rung {rung}"})
        if last and done:
            res.best, best = done[0][2], done[0][1]
            res.best_model = PipelineModel([VectorAssembler(inputCols=feats, outputCol="features"), best])
        staying = {i for i, *_ in done[:keep]}
        left = [c for c in left if c[0] in staying]
    res.trials.sort(key=lambda t: t["trial"])
    data.unpersist()
    res.duration_s = time.time() - started
    return res


def trials_frame(spark: SparkSession, res: SearchResult) -> DataFrame:
    rows = [{"run_id": res.run_id, "created": res.created, **t} for t in res.trials]
    schema = TRIALS_SCHEMA
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], schema=schema)


def append_trials(trials: DataFrame, path: str) -> DataFrame:
    """Append a run's trials to the history at ``path``; returns the history."""
    trials.write.mode("append").parquet(path)
    return trials.sparkSession.read.schema(trials.schema).parquet(path)


TRIALS_SCHEMA = ("run_id string, created double, trial int, algorithm string, params string, "
                 "log_loss double, accuracy double, precision double, recall double, f1 double, "
                 "duration_s double, skipped string, rung int, train_share double")


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """The history at ``path``; older runs have no rungs."""
    return spark.read.schema(TRIALS_SCHEMA).parquet(path)


def run_history(trials: DataFrame) -> DataFrame:
    """(run_id, created, trials, best_trial, best_log_loss), the newest first."""
    whole = F.when(F.col("skipped").isNull(), F.struct("log_loss", "trial"))
    return (trials.groupBy("run_id", "created").agg(F.count(F.lit(1)).alias("trials"), F.min(whole).alias("best"))
            .select("run_id", "created", "trials", F.col("best.trial").alias("best_trial"), F.col("best.log_loss").alias("best_log_loss"))
            .orderBy(F.desc("created"), "run_id"))


def held_out(df: DataFrame, seed: int = 42, train_fraction: float = 0.8) -> DataFrame:
    """The rows that the searches don't train on."""
    return df.where(F.pmod(F.xxhash64(KEY, F.lit(seed)), F.lit(10_000)) >= int(train_fraction * 10_000))


def result_record(spark: SparkSession, res: SearchResult, model_path: str) -> DataFrame:
    """One row describing the search (the reference's result dict)."""
    b = res.best or {}
    row = {"run_id": res.run_id, "model_path": model_path,
           "best_log_loss": b.get("log_loss"), "best_algorithm": b.get("algorithm"),
           "n_trials": sum("skipped" not in t for t in res.trials), "duration_s": res.duration_s,
           "n_features": len(res.features), "n_rows": res.n_rows,
           "n_columns": len(res.features) + 2}
    return spark.createDataFrame([row], schema=(
        "run_id string, model_path string, best_log_loss double, best_algorithm string, "
        "n_trials int, duration_s double, n_features int, n_rows long, n_columns int"))


def best_trial(trials: DataFrame) -> DataFrame:
    """The newest run's trial with the lowest log loss (ties: lower trial)."""
    newest = trials.select(F.max("created")).scalar()
    return trials.where((F.col("created") == newest) & F.col("skipped").isNull()).orderBy("log_loss", "trial").limit(1)


def feature_importance(model: PipelineModel, features: list[str], data: DataFrame | None = None) -> DataFrame:
    """(feature, importance) sorted descending.

    Tree models give ``featureImportances``; a logistic regression gives the
    absolute coefficient times the feature's standard deviation (the effect of
    one standard deviation), which needs one aggregate over ``data``.
    """
    spark = data.sparkSession if data is not None else SparkSession.getActiveSession()
    clf = model.stages[-1]
    if hasattr(clf, "featureImportances"):
        vals = clf.featureImportances.toArray().tolist()
    else:
        coef = clf.coefficients.toArray().tolist()
        if data is not None:
            sd = data.agg(*[F.stddev_samp(c) for c in features]).first()
            vals = [abs(c) * (s or 0.0) for c, s in zip(coef, sd)]
        else:
            vals = [abs(c) for c in coef]
    rows = [(f, float(v)) for f, v in zip(features, vals)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))


def permutation_importance(model: PipelineModel, features: list[str], data: DataFrame, target: str = TARGET,
                           key: str = KEY, seed: int = 7) -> DataFrame:
    """(feature, importance, base_log_loss) sorted descending: by how much the
    log loss over ``data`` rises when a feature's values are dealt to other rows.

    The same measure for every kind of model. A feature's values are permuted by
    two ranks of keyed hashes: a row takes the value of the row whose second rank
    is its first. All features are then scored in one pass, each row once for
    every feature.
    """
    spark, n = data.sparkSession, len(features)
    rows = stored(data.select(F.col(key).cast("string").alias("key"), F.col(target).cast("int").alias(TARGET),
                              F.array(*[F.col(f).cast("double") for f in features]).alias("x")))
    # group 2 j for the row that takes, 2 j + 1 for the one that gives
    cells = rows.select("key", F.posexplode("x").alias("j", "value")).select(
        "key", "value", F.explode(F.array(F.col("j") * 2, F.col("j") * 2 + 1)).alias("g"))
    placed = positions(cells.withColumn("h", F.xxhash64("key", "g", F.lit(seed))), "g", ["h", "key"])
    takes = placed.where("g % 2 = 0").select((F.col("g") / 2).cast("int").alias("j"), "pos", "key")
    gives = placed.where("g % 2 = 1").select((F.floor(F.col("g") / 2)).cast("int").alias("j"), "pos", "value")
    dealt = takes.join(gives, ["j", "pos"]).groupBy("key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", "value"))), lambda c: c["value"]).alias("y"))  # one row's features
    swapped = rows.join(dealt, "key").select(TARGET, "x", F.posexplode("y").alias("j", "v"))
    vectors = swapped.select("j", TARGET, F.transform("x", lambda old, i: F.when(i == F.col("j"), F.col("v")).otherwise(old)).alias("x"))
    every = vectors.union(rows.select(F.lit(-1), TARGET, "x")).select("j", TARGET, array_to_vector("x").alias("features"))
    p = F.get(vector_to_array("probability"), F.lit(1))
    q = F.least(F.greatest(F.when(F.col(TARGET) == 1, p).otherwise(1.0 - p), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = model.stages[-1].transform(every).groupBy("j").agg(F.avg(-F.log(q)).alias("loss")).collect()  # a row a feature
    base = next((r.loss for r in loss if r.j == -1), None)
    out = [(features[r.j], r.loss - base, base) for r in loss if r.j >= 0]
    return spark.createDataFrame(out, "feature string, importance double, base_log_loss double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def _exists(path: str) -> bool:
    spark = SparkSession.getActiveSession()
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def save_vocabulary(spark: SparkSession, vocab: dict[str, list[str]], model_path: str) -> None:
    """The one-hot vocabulary, kept beside the model it was fitted with."""
    rows = [(c, v) for c, values in vocab.items() for v in values or [None]]
    spark.createDataFrame(rows, "column_name string, value string").write.mode("overwrite").parquet(f"{model_path}_vocabulary")


def load_vocabulary(spark: SparkSession, model_path: str) -> dict[str, list[str]]:
    vocab: dict[str, list[str]] = {}
    for c, v in spark.read.parquet(f"{model_path}_vocabulary").collect():  # the model's columns
        vocab.setdefault(c, []).extend([v] if v is not None else [])
    return {c: sorted(v) for c, v in vocab.items()}


def load_best_model(path: str | None = None, fallback_path: str | None = None,
                    trials: DataFrame | None = None, model_root: str | None = None) -> PipelineModel:
    """Load ``path``; else ``fallback_path``; else the best trial of the
    newest run, found in ``trials`` and stored under ``model_root/<run_id>``."""
    for p in (path, fallback_path):
        if p and _exists(p):  # a model that is there but can't be read is an error
            return PipelineModel.load(p)
    if trials is not None and model_root:
        b = best_trial(trials).first()
        if b is not None:
            return PipelineModel.load(f"{model_root}/{b['run_id']}")
    raise FileNotFoundError("no model found at the given paths or in the trials table")


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """(customer_id, prediction, probability[P(0), P(1)]) for every row."""
    out = model.transform(features)
    return out.select(KEY, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability").alias("probability"))


def confusion_counts(pred: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    return (pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def classification_metrics(pred: DataFrame, label: str = TARGET, prediction: str = "prediction",
                           probability: str | None = None) -> DataFrame:
    """Accuracy, precision / recall / F1 of the positive class and, with the
    column of its probability, log loss, from one aggregate over the scored
    rows. Probabilities are kept 1e-15 away from 0 and 1."""
    y, p = F.col(label), F.col(prediction)
    if probability:
        q = F.least(F.greatest(F.when(y == 1, F.col(probability)).otherwise(1.0 - F.col(probability)), F.lit(1e-15)), F.lit(1 - 1e-15))
        loss = [F.avg(-F.log(q)).alias("log_loss")]
    else:
        loss = []
    c = pred.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if((y == 1) & (p == 1)).alias("tp"),
                 F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"),
                 F.count_if(y == p).alias("correct"), *loss)
    prec = F.when(F.col("tp") + F.col("fp") == 0, F.lit(0.0)).otherwise(
        F.col("tp") / (F.col("tp") + F.col("fp")))
    rec = F.when(F.col("tp") + F.col("fn") == 0, F.lit(0.0)).otherwise(
        F.col("tp") / (F.col("tp") + F.col("fn")))
    return c.select(
        (F.col("correct") / F.col("n")).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        F.when(prec + rec == 0, F.lit(0.0)).otherwise(F.lit(2.0) * prec * rec / (prec + rec)).alias("f1"),
        *(["log_loss"] if loss else []))
