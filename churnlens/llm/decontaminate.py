"""Benchmark decontamination: BM25 over an inverted index of test items,
searched by block-max WAND, with overlap checks on question and answer.

Index. Items of similar length (a factor of 4) share an index; in it, items
with the same frequent terms lie next to each other, in blocks of ``BLOCK``.
Each term has a posting list, the items that hold it with their BM25 weights,
cut by blocks, and the largest weight of each block. Document frequencies are counted over all items. At most about
``PASS_ITEMS`` items and ``PASS_BYTES`` of text are searched in one pass over
the corpus; a larger benchmark takes more passes, so what is broadcast is
bounded.

Queries. A document's passages are windows of twice an index's longest item,
one such length apart, so any run of an item lies whole in one of them. A
passage's distinct terms are ordered by their largest weight. Those whose sum,
from the smallest on, stays below every threshold can't make a hit by
themselves: only blocks in the lists of the others, from the pivot on, are
candidates. Where the block maxima of all the passage's terms sum to less than
the block's lowest threshold, the block is skipped, its postings unread. The
other blocks are scored exactly, and every item at or above ``share`` of the
score that its own text gets is retrieved: no top-k. The walk is made for many
passages at once, in arrays. Where the checks below can be met with a lower
score, that is the item's threshold, so retrieval loses nothing that the checks
would confirm.

Checks. An item's question is its text up to its last sentence, its answer that
sentence (a text of one sentence is halved). A hit stands when the passage
holds ``overlap`` of the distinct three-word runs of both; a part of fewer
words must be there as a whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import slices, written

BLOCK, PASS_ITEMS, PASS_BYTES = 16, 1024, 1 << 20
#: (term of a passage, block) pairs that a step of the walk holds.
ENTRIES = 500_000
K1, B = 1.2, 0.75
_PUNCTUATION = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words(text: str) -> list[str]:
    return [w for w in (_PUNCTUATION.sub("", x) for x in text.lower().split()) if w]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words, _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    all_words = words(text)
    half = (len(all_words) + 1) // 2
    return all_words[:half], all_words[half:] or all_words[:half]


def runs(ws: list[str], n: int = 3) -> set[tuple]:
    """Distinct runs of n words; of all words where they are fewer."""
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))}


def overlap_of(part: set[tuple], ws: list[str], known: dict[int, set]) -> float:
    """Share of the runs of ``part`` that the words hold."""
    n = len(next(iter(part)))
    if n not in known:
        known[n] = runs(ws, n)
    return len(part & known[n]) / len(part)


def least_score(parts: list[set[tuple]], weight: dict[str, float], overlap: float) -> float:
    """No passage that holds ``overlap`` of the runs of each part scores less:
    a term's weight is shared out evenly to the runs that hold it, and each
    part's cheapest runs are summed."""
    held = Counter(t for p in parts for run in p for t in set(run))
    cost = [sorted(sum(weight[t] / held[t] for t in set(run)) for run in p) for p in parts]
    return sum(sum(c[:math.ceil(overlap * len(c) - 1e-9)]) for c in cost)


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers from low[i] to high[i]: (i, number)."""
    n = high.astype(np.int64) - low
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


class Index:
    """Inverted index of items of similar length. ``df``: term -> items of the
    whole benchmark that hold it."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n: int, mean: float, share: float,
                 overlap: float):
        split = [(sorted(set(w), key=lambda t: (-df[t], t))[:4], len(w), i, w, t) for i, t in items if (w := words(t))]
        split.sort(key=lambda x: x[:3])
        self.items = [(i, *map(runs, question_and_answer(t))) for _, _, i, _, t in split]
        self.longest = max(x[1] for x in split)
        self.term = {t: k for k, t in enumerate(sorted({x for r in split for x in r[3]}))}
        rows, self.needed = [], np.zeros(len(split))
        for col, (_, size, _, w, _) in enumerate(split):
            weight = {}
            for t, tf in Counter(w).items():
                idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                weight[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
            rows += [(self.term[t], col, x) for t, x in weight.items()]
            _, q, r = self.items[col]
            self.needed[col] = min(share * sum(weight.values()), least_score([q, r], weight, overlap))
        rows.sort(key=lambda x: x[:2])
        term = np.array([r[0] for r in rows])
        self.col, self.weight = np.array([r[1] for r in rows], np.int32), np.array([r[2] for r in rows])
        # entry: a term's postings in a block; ``posting`` are their starts, ``entry`` those of a term's entries
        block = self.col // BLOCK
        starts = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])]))
        self.posting = np.append(starts, len(rows)).astype(np.int32)
        self.block, self.block_max = block[starts], np.maximum.reduceat(self.weight, starts)
        self.entry = np.searchsorted(term[starts], np.arange(len(self.term) + 1)).astype(np.int32)
        self.top = np.maximum.reduceat(self.block_max, self.entry[:-1])
        self.blocks = -(-len(split) // BLOCK)
        # a sum may be off in its last digits
        self.lowest = np.minimum.reduceat(self.needed, np.arange(0, len(split), BLOCK)) * (1 - 1e-9)
        self.met, self.skipped = 0, 0

    def windows(self, size: int) -> int:
        """Passages of a document of so many words."""
        return max(1, -(-size // self.longest) - 1)

    def candidates(self, ids: list[np.ndarray]):
        """(document, first word, column, score) of the passages and items at or
        above the item's threshold; ``ids``: each document's terms, -1 outside
        the index."""
        step, width = self.longest, len(self.term)
        count = np.array([self.windows(len(x)) for x in ids])
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        at = np.concatenate([np.arange(len(x)) for x in ids]) // step
        term = np.concatenate(ids)
        known = term >= 0
        doc, at, term = doc[known], at[known], term[known]
        keys = []
        for k in (at, at - 1):
            inside = (k >= 0) & (k < count[doc])
            keys.append((first[doc[inside]] + k[inside]) * width + term[inside])
        key = np.sort(np.concatenate(keys))
        if not len(key):
            return
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        window, term = key // width, key % width
        ends = np.append(np.flatnonzero(window[1:] != window[:-1]) + 1, len(key))
        done = np.cumsum(self.entry[term + 1] - self.entry[term])
        at = 0
        while at < len(key):  # whole passages of about ENTRIES entries
            k = np.searchsorted(done[ends - 1], (done[at - 1] if at else 0) + ENTRIES, "right")
            to = ends[max(k - 1, np.searchsorted(ends, at, "right"))]
            for w, col, score in self._walk(window[at:to], term[at:to]):
                d = int(np.searchsorted(first, w, "right")) - 1
                yield d, int(w - first[d]) * step, col, score
            at = to

    def _walk(self, window: np.ndarray, term: np.ndarray) -> list[tuple]:
        """(passage, column, score) of what reaches its threshold, for the
        distinct terms of passages, sorted by passage."""
        start = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(window))))
        order = np.lexsort((self.top[term], of))
        total = np.cumsum(self.top[term[order]])
        below = np.concatenate([[0], total])[start]
        pivot = np.zeros(len(term), bool)
        pivot[order] = total - below[of] >= self.lowest.min() * (1 - 1e-9)
        if not pivot.any():
            return []
        pair, entry = _spread(self.entry[term], self.entry[term + 1])
        place = of[pair] * self.blocks + self.block[entry]
        held = np.zeros(len(start) * self.blocks, bool)
        held[place[pivot[pair]]] = True
        bound = np.bincount(place, self.block_max[entry], len(held))
        walked = held & (bound.reshape(-1, self.blocks) >= self.lowest).ravel()
        touched = np.zeros(len(held), bool)
        touched[place] = True
        self.met += int(touched.sum())
        self.skipped += int(touched.sum() - walked.sum())
        entry, place = entry[walked[place]], place[walked[place]]
        if not len(entry):
            return []
        mine, posting = _spread(self.posting[entry], self.posting[entry + 1])
        key, inverse = np.unique(place[mine] // self.blocks * len(self.needed) + self.col[posting], return_inverse=True)
        score = np.bincount(inverse, self.weight[posting])
        col = key % len(self.needed)
        hit = score >= self.needed[col] - 1e-9
        names = window[start]
        return list(zip(names[key[hit] // len(self.needed)].tolist(), col[hit].tolist(), score[hit].tolist()))

    def hits(self, texts: list[str], ids: list[np.ndarray], overlap: float) -> list[dict[int, tuple]]:
        """For each document: item -> (score, question overlap, answer overlap,
        first word) of the best standing passage."""
        best: list[dict[int, tuple]] = [{} for _ in texts]
        held, known = (None, 0), {}
        for d, a, col, score in self.candidates(ids):
            if held[0] != d:
                all_words = words(texts[d])
            if held != (d, a):
                held, known, part = (d, a), {}, all_words[a:a + 2 * self.longest]
            item, q, r = self.items[col]
            qo, ro = (overlap_of(x, part, known) for x in (q, r))
            if qo >= overlap and ro >= overlap:
                got = (round(score, 6), qo, ro, a)
                old = best[d].get(item)
                if not old or (got[0], -a) > (old[0], -old[3]):
                    best[d][item] = got
        return best


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.5, overlap: float = 0.6,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """id, item_id, score, question_overlap, answer_overlap and first_word, a
    row for each document and item that stand; clean documents give none.

    Words are lower-cased and stripped of punctuation. Null and empty texts on
    either side match nothing. Items that repeat an id give a row each;
    documents that repeat an id too. A null document or item id is returned as
    null. Empty tables give an empty result; other columns are ignored.
    """
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    kind = pa.string() if item_type == "string" else pa.int32() if item_type == "int" else pa.int64()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    schema = f"id {id_type}, item {item_type}, score double, question_overlap double, answer_overlap double, first_word long"
    found = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, share, overlap, text_col, item_col):

        def run(batches, index=index):
            at, names = index.value
            search = Search(at, overlap)
            for batch in slices(batches, 128):
                out = [[] for _ in range(6)]
                for i, found in zip(batch.column(0).to_pylist(), search(batch.column(1).to_pylist())):
                    for item, got in sorted(found.items()):
                        for c, v in zip(out, (i, names[item], *got)):
                            c.append(v)
                yield pa.record_batch([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], kind)]
                                      + [pa.array(c, pa.float64()) for c in out[2:5]] + [pa.array(out[5], pa.int64())],
                                      names=["id", "item", "score", "question_overlap", "answer_overlap", "first_word"])

        found = found.union(rows.mapInArrow(run, schema))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def clean(docs: DataFrame, benchmark: DataFrame, share: float = 0.5, overlap: float = 0.6,
          text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` in which no item stands, by the rules of
    ``contaminated``; rows without id are judged like others."""
    for index in indexes(benchmark, share, overlap, text_col, item_col):
        docs = docs.where(_holds_none(index, overlap)(F.coalesce(F.col(text_col), F.lit(""))))
    return docs


def _holds_none(index, overlap: float):
    @F.pandas_udf("boolean")
    def holds_none(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = Search(index.value[0], overlap)  # one for a task
        for texts in batches:
            yield pd.Series([not x for k in range(0, len(texts), 128) for x in search(list(texts[k:k + 128]))])

    return holds_none


class Search(dict):
    """A batch of texts -> hits of each in a pass's indexes. As a dict: raw word
    -> its number, which ``terms`` maps to the term of each index; emptied when
    it holds 250,000 words."""

    def __init__(self, indexes: list[Index], overlap: float):
        super().__init__()
        self.indexes, self.overlap = indexes, overlap
        self.number = {w: k for k, w in enumerate(sorted({w for x in indexes for w in x.term}))}
        names = list(self.number)
        # the last two: words outside all indexes, and words without letters or digits
        self.terms = [np.array([x.term.get(w, -1) for w in names] + [-1, -1]) for x in indexes]

    def __missing__(self, raw: str) -> int:
        if len(self) >= 250_000:
            self.clear()
        w = raw if raw.isalnum() else _PUNCTUATION.sub("", raw)
        self[raw] = k = self.number.get(w, len(self.number)) if w else len(self.number) + 1
        return k

    def __call__(self, texts: list[str]) -> list[dict[int, tuple]]:
        numbers = []
        for t in texts:
            raw = t.lower().split()
            n = np.fromiter(map(self.__getitem__, raw), np.int64, len(raw))
            numbers.append(n[n <= len(self.number)])
        out: list[dict[int, tuple]] = [{} for _ in texts]
        for index, terms in zip(self.indexes, self.terms):
            for found, more in zip(out, index.hits(texts, [terms[n] for n in numbers], self.overlap)):
                found.update(more)
        return out


def indexes(benchmark: DataFrame, share: float, overlap: float, text_col: str, item_col: str):
    """A broadcast (indexes, item ids) for each pass; an item's number in the
    index is its place in the list, as ids may repeat."""
    spark = benchmark.sparkSession
    items = written(benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null"), "items")

    @F.pandas_udf("array<string>")
    def terms(texts):
        return texts.map(words)

    listed = items.select(terms("text").alias("w"))
    n, mean = listed.where("size(w) > 0").agg(F.count(F.lit(1)), F.avg(F.size("w"))).first()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    frequency = written(listed.select(F.explode(F.array_distinct("w")).alias("t")).groupBy("t").count(), "frequencies")
    passes = max(1, -(-n // PASS_ITEMS), -(-size // PASS_BYTES))
    numbered = items.withColumn("pass", F.pmod(F.xxhash64("item", "text"), F.lit(passes)))
    for k in range(passes):
        mine = numbered.where(F.col("pass") == k).select("item", "text")
        some = mine.orderBy("item", "text").collect()  # about PASS_ITEMS items and PASS_BYTES
        used = mine.select(F.explode(F.array_distinct(terms("text"))).alias("t")).distinct()
        df = dict(map(tuple, frequency.join(used, "t", "left_semi").collect()))
        if df:
            classes: dict[int, list] = {}
            for i, r in enumerate(some):
                if size := len(words(r["text"])):
                    classes.setdefault(max(2, (size - 1).bit_length() // 2), []).append((i, r["text"]))
            yield spark.sparkContext.broadcast(([Index(x, df, n, mean, share, overlap) for _, x in sorted(classes.items())],
                                                [r["item"] for r in some]))
