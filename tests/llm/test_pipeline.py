"""The pipeline's stages against brute force on a small table."""

import numpy as np
import pytest

import corpus_pipeline as cp
from churnlens.llm import decontaminate, mixing, quality
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_mixing import brute as mixed

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(df.collect(), key=str)


@pytest.fixture(scope="module")
def stages(spark):
    from churnlens.llm.common import written
    from churnlens.sources.fixtures import read_table
    docs, out = read_table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        got = written(stage(spark, docs, SF), f"test-{name}")
        out.append((docs, got))
        docs = got
    return dict(zip([n for n, _ in cp.STAGES], out))


def test_columns(stages):
    assert all(a.columns == b.columns for a, b in list(stages.values())[:-1])


def test_quality(spark, stages):
    from churnlens.sources.fixtures import read_table
    a, b = stages["quality"]
    w = quality.fitted(a, read_table(spark, SF, "labels"))
    cache = quality._Hashes()

    def good(t):
        at, x = quality.features(t or "", 18, cache)
        return 1 / (1 + np.exp(-(w[at] @ x + w[-1]))) >= cp.THRESHOLD

    assert rows_of(b) == sorted((r for r in a.collect() if good(r.text)), key=str)


def test_near_duplicates(stages):
    a, b = stages["near_duplicates"]
    keep = {i for i, _, c in components([(r.doc_id, r.text) for r in a.collect()]) if i == c}
    assert rows_of(b) == sorted((r for r in a.collect() if str(r.doc_id) in keep), key=str)
    assert b.count() < a.count()


def test_decontamination(spark, stages):
    from churnlens.sources.fixtures import read_table
    a, b = stages["decontamination"]
    items = [decontaminate.words(r.text) for r in read_table(spark, SF, "benchmark").collect()]
    gone = {r.doc_id for r in a.collect()} - {r.doc_id for r in b.collect()}
    holds = {r.doc_id for r in a.collect() if any(f" {' '.join(i)} " in f" {' '.join(decontaminate.words(r.text))} " for i in items)}
    assert gone == holds


def test_mixing(stages):
    a, b = stages["mixing"]
    rows = [(r.doc_id, f"d{int(r.source[3:]) % 4}", r.lang, r.source, len(r.text.encode().split())) for r in a.collect()]
    want = {x[0] for x in mixed(rows, mixing.WEIGHTS, **cp.MIX)}
    assert {r.doc_id for r in b.collect()} == want and b.count() == len(want)


def test_sharding(stages):
    a, b = stages["sharding"]
    assert sorted(r.doc_id for r in a.collect()) == sorted(r.doc_id for r in b.collect())


def test_repeated_rows_nulls_and_empty(spark, docs, empty, stages):
    from pyspark.sql import functions as F
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("score"))
    kept = cp.drop_near_duplicates(spark, plain, SF)
    assert kept.columns == plain.columns
    assert kept.where("doc_id = 10").count() <= 1 and kept.where("doc_id is null").count() == 2
    for name, stage in cp.STAGES:
        assert stage(spark, plain, SF).count() > 0, name
        assert stage(spark, plain.where("false"), SF).count() == 0, name
