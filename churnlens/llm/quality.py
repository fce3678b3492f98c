"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

Words and runs of punctuation, lower-cased, are hashed with their bigrams into
``2 ** bits`` coordinates. A word equal to the one before it becomes the word
``<same>`` and a word in capitals is led by ``<caps>``, so repetition and
shouting are n-grams that unseen words share. A coordinate's value is
``sqrt(tf / n)``, which has length 1.

Training uses a bounded sample of the labelled rows (``max_rows``, smallest
hashes of the id first). Its feature rows are dealt to ``shards`` tasks; in
each of ``rounds`` rounds every task runs follow-the-regularised-leader updates
from the common state, ``epochs`` times over its rows, and the states are
averaged per coordinate. The state is 2 ** bits pairs, whatever the input. Scoring maps all
documents, whole texts, to sparse dot products.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import slices, written

WORDS = re.compile(r"\w+|[^\w\s]+")
_SAME = np.uint64(xxhash.xxh64_intdigest("<same>"))
_CAPS = "<caps>"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    """word -> hash; emptied when it holds 250,000 words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 250_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word.lower())
        if len(word) > 1 and word.isupper():
            h ^= xxhash.xxh64_intdigest(_CAPS)
        self[word] = h
        return h


def features(text: str, bits: int, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Sorted coordinates and values of a text; both empty without words."""
    words = WORDS.findall(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    caps = [i for i, w in enumerate(words) if len(w) > 1 and w.isupper()] if not text.islower() else []
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    h = np.where(same, _SAME, h)
    grams = [h, (h[:-1] * _ODD) ^ (h[1:] + _MIX)]
    if caps:
        grams.append(np.full(len(caps), np.uint64(xxhash.xxh64_intdigest(_CAPS))))
    g = np.concatenate(grams) * _MIX
    g = (g ^ (g >> np.uint64(29))) * _ODD
    at, tf = np.unique((g >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
    return at, np.sqrt(tf / tf.sum())


def ftrl(rows, z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> None:
    """FTRL-proximal updates of the state (z, n) in place; the last coordinate
    is the intercept, which is not regularised."""
    for y, at, x in rows:
        at, x = np.append(at, len(z) - 1), np.append(x, 1.0)
        w = weights(z[at], n[at], alpha, beta, l1, l2)
        w[-1] = -z[-1] * alpha / (beta + np.sqrt(n[-1]))
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
        z[at] += g - s * w
        n[at] += g * g


def weights(z, n, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def train(labelled: DataFrame, max_rows: int = 12_000, shards: int = 4, rounds: int = 4, epochs: int = 5, bits: int = 18,
          alpha: float = 5.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.0) -> np.ndarray:
    """Weights (the last is the intercept) from the columns id, text and label.

    At most ``max_rows`` rows are used: those with the smallest hash of the
    id. Rows with a null label are left out, null texts count as empty. Without
    any row all weights are 0, which scores every text 0.5.
    """
    used = labelled.where("label is not null").select(
        F.xxhash64(F.col("id").cast("string"), F.lit("sample")).alias("h"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("double").alias("label"))
    n = used.count()
    if n > max_rows:
        edge = used.select("h").orderBy("h").limit(max_rows).agg(F.max("h")).first()[0]
        used = used.where(F.col("h") <= edge)

    def extract(batches):
        cache = _Hashes()
        for b in slices(batches):
            got = [features(t, bits, cache) for t in b.column("text").to_pylist()]
            yield pa.record_batch(
                [b.column("h"), b.column("label"), pa.array([a.astype("<i4").tobytes() for a, _ in got], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for _, x in got], pa.binary())], names=["h", "y", "at", "x"])

    rows = written(used.mapInArrow(extract, "h long, y double, at binary, x binary"), "features").withColumn(
        "shard", F.pmod("h", F.lit(shards)).cast("int"))
    spark, size = labelled.sparkSession, 2 ** bits + 1
    z, sq = np.zeros(size), np.zeros(size)
    for k in range(rounds):
        state = spark.sparkContext.broadcast((z, sq))

        def fit(table: pa.Table) -> pa.Table:
            data = sorted(((h, y, np.frombuffer(a, "<i4"), np.frombuffer(x, "<f4").astype(float)) for h, y, a, x in
                          zip(*(table.column(c).to_pylist() for c in ("h", "y", "at", "x")))), key=lambda r: r[:2])
            mine = [v.copy() for v in state.value]
            for turn in range(epochs):
                rng = np.random.default_rng(k * epochs + turn)
                ftrl((data[i][1:] for i in rng.permutation(len(data))), *mine, alpha, beta, l1, l2)
            pack = zstandard.ZstdCompressor()  # most coordinates are zero
            return pa.table({"z": [pack.compress(mine[0].tobytes())], "n": [pack.compress(mine[1].tobytes())]})

        got = rows.groupBy("shard").applyInArrow(fit, "z binary, n binary").toArrow()  # one state per shard
        if got.num_rows:
            z, sq = (sum(np.frombuffer(zstandard.decompress(x.as_py())) for x in got.column(c)) / got.num_rows for c in ("z", "n"))
        state.destroy()
    w = weights(z, sq, alpha, beta, l1, l2)
    w[-1] = -z[-1] * alpha / (beta + np.sqrt(sq[-1]))
    return w


def score(docs: DataFrame, w: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: the probability of label 1.

    Null texts count as empty; a text without words gets the intercept's
    score. An existing column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(w)
    bits = (len(w) - 1).bit_length() - 1

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, cache = shared.value, _Hashes()  # the cache goes with the task
        for texts in parts:
            got = np.empty(len(texts))
            for i, t in enumerate(texts):
                at, x = features(t or "", bits, cache)
                got[i] = w[at] @ x + w[-1]
            yield pd.Series(1 / (1 + np.exp(-np.clip(got, -35, 35))))

    return docs.withColumn(name, probability(F.coalesce(F.col(text_col), F.lit(""))))


def held_out(doc_id) -> F.Column:
    """crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", **training) -> np.ndarray:
    """Weights trained on the labelled rows that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(
        "id is not null and label is not null").where(~held_out(F.col("id")))
    n = known.count()
    bound = training.get("max_rows", 12_000)
    if n > bound:  # cut the labels before their texts are fetched
        known = known.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("sample"))).limit(bound)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return train(texts.join(written(known, "labels"), "id"), **training)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.3, **training) -> DataFrame:
    """id, held_out, score and predicted of every row of ``docs``.

    Labels of held-out ids are never read in training; a null id is never held
    out and has no label. Several labels of one id are all used. Ids may
    repeat: each input row gives one output row. Empty tables give empty
    results, an empty label table the score 0.5.
    """
    w = fitted(docs, labels, id_col, text_col, label_col, **training)
    out = score(docs.select(F.col(id_col), F.col(text_col)), w, id_col, text_col)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
