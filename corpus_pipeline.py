"""Corpus pipeline: documents -> quality -> near duplicates -> benchmark
leaks -> source mix -> shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the shared folder and rereads as the next one's docs. All
but the last return the columns of docs. ``doc_id`` names a document: rows that
repeat an id and text are one document from the second stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import decontaminate, jaccard_join, mixing, quality, sharding
from churnlens.llm.common import without, word_count, written
from churnlens.sources.fixtures import read_table

THRESHOLD = 0.3
#: One epoch: a document comes at most once. Nine tenths of all words stay.
MIX = {"share": 0.9, "epochs": 1, "seed": 17}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at THRESHOLD or more; without any
    label all scores are 0.5 and all documents stay."""
    w = quality.fitted(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, w, name="_score").where(F.col("_score") >= THRESHOLD).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; empty documents and
    rows without id stay. Of rows that repeat an id and text, one stays."""
    found = written(jaccard_join.jaccard_components(docs), "components")
    kept = without(docs, found.where("component_id <> doc_id").select("doc_id"), "doc_id")
    twice = written(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return kept.join(twice, "doc_id", "left_anti").select(docs.columns).union(again)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the budgets of the source tree choose; rows without id
    are not chosen."""
    rows = mixing.document_rows(docs, word_count(F.coalesce("text", F.lit(""))))
    chosen = written(mixing.mix(rows.where("id is not null"), mixing.WEIGHTS, **MIX).select(F.col("id").alias("doc_id")).distinct(), "chosen")
    return docs.join(chosen, "doc_id", "left_semi").select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The classifier and the similarity join have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
