"""Registered queries ``opN_<name>``: each applies operator N, with production
parameters, to its whole table. ORACLE holds DuckDB SQL where SQL can express
the operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import (chat, decontaminate, exact_dedup, jaccard_join, license_scan, merkle, mixing, near_vectors,
                           quality, repair, sharding, token_count, warc)
from churnlens.llm.common import scratch, word_count
from churnlens.sources.fixtures import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


@register(warc.SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC, read the archives back."""
    path = scratch(spark, "warc")
    warc.write_warc(warc.plan_records(read_table(spark, sf_dir, "pages")), path)
    return warc.page_digests(warc.read_warc(spark, path))


@register(chat.SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(rows.union(more)))


@register()
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


@register(exact_dedup.SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


@register()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"))


@register()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register()
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register(mixing.SQL)
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """60 percent of all words, at most 2 epochs of a source."""
    docs = read_table(spark, sf_dir, "documents")
    rows = mixing.document_rows(docs, word_count(F.coalesce("text", F.lit(""))))
    return mixing.mix(rows, mixing.WEIGHTS, **mixing.PRODUCTION).withColumnRenamed("id", "doc_id")


@register()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


@register()
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


@register(merkle.SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.newline_tampering(read_table(spark, sf_dir, "documents")).drop("copied")


@register(repair.SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(read_table(spark, sf_dir, "conversations"))


@register(near_vectors.SQL)
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))
