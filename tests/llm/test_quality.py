import numpy as np
import pytest

from churnlens.llm import quality as q
from churnlens.sources.fixtures import read_table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = q.classify(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    rows = got.join(read_table(spark, SF, "labels"), "doc_id").collect()
    assert all(r.held_out == q.is_held_out(r.doc_id) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(r.predicted == 1 for r in held if r.quality == 1)
    assert got.count() == read_table(spark, SF, "documents").count()


def test_held_out_labels_are_not_read(spark):
    docs, labels = read_table(spark, "/root/testdata/sf0.001", "documents"), read_table(spark, "/root/testdata/sf0.001", "labels")
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in q.classify(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_edge_cases(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (3, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = q.classify(docs, labels, rounds=2).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert not [r for r in got if r.doc_id is None and r.held_out]
    assert q.classify(empty, labels).count() == 0
    assert {r.score for r in q.classify(docs, labels.where("false")).collect()} == {0.5}


def test_bounded_sample(spark):
    """The rows with the smallest hashes alone give the same weights."""
    from pyspark.sql import functions as F
    labels = read_table(spark, SF, "labels")
    rows = read_table(spark, SF, "documents").join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), "text", F.col("quality").alias("label"))
    least = rows.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("sample"))).limit(50)
    w, same = q.train(rows, max_rows=50, rounds=2), q.train(least, rounds=2)
    assert len(w) == 2 ** 18 + 1 and np.any(w[:-1])
    assert np.allclose(w, same) and not np.allclose(w, q.train(rows, max_rows=51, rounds=2))


def test_features():
    cache = q._Hashes()
    at, x = q.features("Go go GO stop!! stop!!", 18, cache)
    assert np.isclose((x ** 2).sum(), 1) and (np.diff(at) > 0).all()
    assert len(q.features(" \n", 18, cache)[0]) == 0


def test_ftrl_learns_and_l1_gives_zeros():
    rng = np.random.default_rng(0)
    rows = [(float(k % 2), np.array([k % 2, 2 + rng.integers(50)]), np.array([0.7, 0.7])) for k in range(600)]
    z, n = np.zeros(101), np.zeros(101)
    q.ftrl(rows, z, n, 1.0, 1.0, 0.5, 0.0)
    w = q.weights(z, n, 1.0, 1.0, 0.5, 0.0)
    assert w[1] > 0.5 and w[0] < -0.5 and not w[60:100].any()


@pytest.mark.parametrize("text", ["", None, "one"])
def test_score_keeps_rows(spark, text):
    table = spark.createDataFrame([(1, text, 2.0)], "doc_id long, text string, score double")
    r = q.score(table, np.zeros(2 ** 10 + 1)).first()
    assert r.score == 0.5 and q.score(table, np.zeros(2 ** 10 + 1)).columns == ["doc_id", "text", "score"]
