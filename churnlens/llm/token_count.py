"""Token counts by distinct pre-tokens.

A byte-level BPE splits a text into pre-tokens and encodes each by itself, so
a document's token count is a sparse product: frequency of each pre-token in
the document times the pieces of that pre-token.

1. Blocks of documents are cut into pre-tokens. For each bucket of pre-tokens
   (by hash), a block gives one packed row: the pre-tokens, the documents of
   the block that hold them and their frequencies, a few bytes for each.
2. The one shuffle brings a bucket's rows together. They pass one at a time; a
   bucket's distinct pre-tokens are counted by the library when first seen,
   once each, and met with the frequencies of each block there. No token id is
   kept.
3. Products are summed per block and document within each task, then per block.

A pre-token in most documents (a space and a frequent word) has few bytes per
document, but its bucket would grow with the corpus. So pre-tokens in over 1 /
``COMMON`` of a block's documents, of which there are at most ``COMMON`` times
the pre-tokens of a mean document, go to a bucket chosen by the block; each
bucket counts those it meets once.
"""

from __future__ import annotations

import json
import re
import struct
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import pairs

#: Documents and characters after which a block is closed.
BLOCK_DOCS, BLOCK_CHARS = 16384, 4_000_000
COMMON = 4
#: The pattern of byte-level BPE (fixed value, as the library applies it).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Above this, the character classes of ``regex`` and of the library can come
#: from different Unicode versions; such texts are cut by the library itself.
BEYOND = re.compile("[\u0530-\U0010ffff]")
#: Texts of these characters only are cut by ``re``, where its classes agree.
PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*")
PLAIN_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def _tokenizer(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def pre_tokenizer(path: str):
    """text -> (list of pre-tokens, number of special tokens in the text)."""
    import regex
    tok = None  # loaded by the first text that needs it
    with open(path, encoding="utf-8") as f:
        special = [a["content"] for a in json.load(f)["added_tokens"]]
    cut = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
    find, plain = regex.compile(PATTERN).findall, PLAIN_PATTERN.findall

    def by_library(s: str) -> list[str]:
        nonlocal tok
        tok = tok or _tokenizer(path)
        return [s[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(s)]

    def run(text: str) -> tuple[list[str], int]:
        of = plain if PLAIN.fullmatch(text) else by_library if BEYOND.search(text) else find
        if cut is None or not cut.search(text):
            return of(text), 0
        parts = cut.split(text)
        return [t for p in parts for t in of(p)], len(parts) - 1

    return run


def _pack(values: np.ndarray) -> bytes:
    """Little-endian unsigned integers, in the fewest bytes that hold all."""
    top = int(values.max())
    return values.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}")


def _block_rows(ids: list, sizes: list[int], texts: list[str], run, buckets: int):
    """(bucket, block, packed row) of one block; a row with bucket -1 holds the
    documents' ids, sizes in bytes and special tokens."""
    vocab: dict[str, int] = defaultdict(count().__next__)
    tok, freq, doc, special, name = [], [], [], [], xxhash.xxh3_128()
    for k, text in enumerate(texts):
        got, more = run(text)
        special.append(more)
        name.update(text.encode())
        if got:
            t, f = np.unique(np.fromiter(map(vocab.__getitem__, got), np.int64, len(got)), return_counts=True)
            tok.append(t)
            freq.append(f)
            doc.append(np.full(len(t), k, np.int32))
    head = json.dumps([ids, sizes, special]).encode()
    name.update(head)
    block = name.hexdigest()
    yield -1, block, head
    if not tok:
        return
    tok, freq, doc = np.concatenate(tok), np.concatenate(freq), np.concatenate(doc)
    words = [w.encode() for w in vocab]
    held = np.bincount(tok, minlength=len(words))
    at = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
    at[held * COMMON > len(texts)] = xxhash.xxh3_64_intdigest(block) % buckets
    order = np.argsort(at, kind="stable")  # of words, by bucket
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    entries = np.argsort(rank[tok], kind="stable")
    freq, doc, held, at = freq[entries], doc[entries], held[order], at[order]
    ends = np.concatenate([[0], np.cumsum(held)])
    cut = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]])
    squeeze = zstandard.ZstdCompressor(level=1)
    for a, b in zip(cut[:-1], cut[1:]):
        f, d, mine = freq[ends[a]:ends[b]], doc[ends[a]:ends[b]], [words[i] for i in order[a:b]]
        wide = 1 if f.max() < 256 else 4
        yield int(at[a]), block, squeeze.compress(b"".join([
            struct.pack("<IIIB", len(texts), b - a, len(f), wide),
            np.fromiter(map(len, mine), "<u4", len(mine)).tobytes(), held[a:b].astype("<u4").tobytes(),
            d.astype("<u2").tobytes(), f.astype(f"<u{wide}").tobytes(), *mine]))


def _unpacked(data: bytes):
    """Documents of the block, pre-tokens, and for each entry: number of its
    pre-token, document, frequency."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n, words, entries, wide = struct.unpack_from("<IIIB", data)
    at = 13

    def take(kind, k):
        nonlocal at
        out = np.frombuffer(data, kind, k, at)
        at += out.nbytes
        return out

    sizes, held = take("<u4", words), take("<u4", words)
    doc, freq = take("<u2", entries), take(f"<u{wide}", entries)
    ends = (at + np.cumsum(sizes)).tolist()
    return n, [data[a:b] for a, b in zip([at, *ends], ends)], np.repeat(np.arange(words), held), doc, freq


def _packed_sums(values: np.ndarray) -> bytes:
    at = np.flatnonzero(values)
    return zstandard.ZstdCompressor(level=1).compress(
        struct.pack("<I", len(at)) + at.astype("<u2").tobytes() + values[at].astype("<u8").tobytes())


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers
    library, readable on every executor (it is installed there, like a
    library). Counts are those of the library without added special tokens;
    special strings inside a text count as one token each, its default. Null
    texts count as empty: 0 bytes, 0 tokens. Ids may be null or repeated: each
    input row gives one output row. Texts are cut whole, however long. An empty
    table gives an empty result; other columns are ignored. Rows should come
    in a repeatable order, as from files or a checkpoint: a block recomputed
    after the loss of an executor must hold the same documents.
    """
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    buckets = max(256, docs.count() // 256)

    def batches_of(found):
        done, held = [], 0
        for row in found:
            done.append(row)
            held += len(row[2])
            if held > 4 << 20:
                yield _batch(done)
                done, held = [], 0
        if done:
            yield _batch(done)

    def _batch(done):
        b, k, d = zip(*done)
        return pa.record_batch([pa.array(b, pa.int64()), pa.array(k, pa.string()), pa.array(d, pa.binary())],
                               names=["bucket", "block", "data"])

    def cut(batches):
        run = pre_tokenizer(vocabulary)

        def found():
            ids, sizes, texts, held = [], [], [], 0
            for i, t in pairs(batches):
                ids.append(i)
                sizes.append(len(t.encode()))
                texts.append(t)
                held += len(t)
                if len(ids) >= BLOCK_DOCS or held >= BLOCK_CHARS:
                    yield from _block_rows(ids, sizes, texts, run, buckets)
                    ids, sizes, texts, held = [], [], [], 0
            if ids:
                yield from _block_rows(ids, sizes, texts, run, buckets)

        yield from batches_of(found())

    schema = "bucket long, block string, data binary"

    def multiply(batches):
        """Sums per block; the documents' rows pass unchanged."""
        tok = _tokenizer(vocabulary)

        def found():
            pieces, now, sums, held = {}, None, {}, 0
            for batch in batches:
                for bucket, block, data in zip(*(c.to_pylist() for c in batch.columns)):
                    if bucket < 0:
                        yield bucket, block, data
                        continue
                    if bucket != now:
                        pieces, now = {}, bucket
                    n, words, word, doc, freq = _unpacked(data)
                    new = [w for w in words if w not in pieces]
                    pieces.update(zip(new, (len(e.ids) for e in tok.encode_batch_fast(
                        [w.decode() for w in new], add_special_tokens=False))))
                    each = np.fromiter((pieces[w] for w in words), np.int64, len(words))
                    got = np.bincount(doc, each[word] * freq, n).astype(np.int64)
                    if block in sums:
                        sums[block] += got
                    else:
                        sums[block] = got
                        held += n
                        if held > 2_000_000:
                            yield from ((0, k, _packed_sums(v)) for k, v in sums.items())
                            sums, held = {}, 0
            yield from ((0, k, _packed_sums(v)) for k, v in sums.items())

        yield from batches_of(found())

    def finish(table: pa.Table) -> pa.Table:
        kind, data = table.column("bucket").to_pylist(), table.column("data").to_pylist()
        ids, sizes, special = json.loads(data[kind.index(-1)])
        total, copies = np.zeros(len(ids), np.int64), kind.count(-1)
        for k, d in zip(kind, data):
            if k == 0:
                d = zstandard.ZstdDecompressor().decompress(d)
                n = struct.unpack_from("<I", d)[0]
                total[np.frombuffer(d, "<u2", n, 4)] += np.frombuffer(d, "<u8", n, 4 + 2 * n).astype(np.int64)
        total = total // copies + np.array(special)  # blocks that are equal throughout share a name
        return pa.table([pa.array(ids * copies, pa.string()), pa.array(sizes * copies, pa.int64()),
                         pa.array(total.tolist() * copies, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    parts = (rows.mapInArrow(cut, schema).repartition("bucket", F.when(F.col("bucket") < 0, F.col("block")))
             .sortWithinPartitions("bucket").mapInArrow(multiply, schema))
    done = parts.groupBy("block").applyInArrow(finish, "id string, n_bytes long, n_tokens long")
    return done.select(F.col("id").cast(id_type).alias(id_col), "n_bytes", "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"))
