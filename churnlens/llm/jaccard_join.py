"""N-gram Jaccard self-join by PartEnum signatures, and its components.

A document is the set of 64-bit hashes of its distinct ``width``-word
shingles. Sizes fall into bands whose ends differ by the factor 1 / threshold,
so linked sets lie in the same band or in neighbours. For each band's sizes
the largest Hamming distance ``k`` of linked sets is known. The hash domain is
cut into ``n1 > k`` ranges; linked sets differ in at most ``k`` of them, so
they agree on at least ``n1 - k``. The contents of each range (a subset of the
domain partition) hashed with band and range give the signatures.

A range may be empty, or hold only passages that very many documents share.
Signatures of empty ranges, and groups of over ``CROWD`` sets, need no
expansion for a set that has fewer than ``n1 - k`` of both: it agrees with any
linked set on ranges outside them, and on how many is known: ``need``, which is
``n1 - k`` less its empty and crowded ranges. So pairs of smaller groups are
counted, and only those that agree often enough for both are candidates.

Sets whose need is not positive are deficient: near copies in large groups, or
short sets of common wording. Among them the enumeration has two levels: the
domain is cut into fewer, wider ranges, each into parts, of which at most ``k2``
differ in one range; every choice of the other parts is a signature. It covers
several times the shingles, so common wording alone does not meet in it. This
loses no link.

Links are found without emitting all pairs. Each set is first compared with its
smallest candidate, then with candidates of other components. Of the groups of
deficient sets, those within one component are done. In the others, the open
ones, each set is compared with the smallest set of one of its groups, so near
copies of one text become one component in as many comparisons as there are
sets. Only groups that are open after ``LEADS`` times tie their sets into
families; a set gives one row a bucket for this, whatever its signatures and the
sizes of their groups. A family's sets are compared in blocks of about ``BLOCK``
shingles: a task holds two blocks, counts shared shingles through their
postings, and returns only links that join components. Every comparison is on
the whole shingle sets.

One tokenising pass and one shuffle carry the packed signatures; each task of
that shuffle reads its buckets one after another, so memory is a bucket's.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import ASCII_LOWER, released, slices, written

#: Sets in a signature's group from which on it counts as crowded.
CROWD = 16
#: Shingles of a block of a family's sets.
BLOCK = 500_000
#: Times that deficient sets are compared with one of their pivots.
LEADS = 2
#: Signatures that a map task packs at a time.
PACK = 400_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """word -> hash; emptied when it holds 250,000 words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 250_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str, cache: WordHashes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles. Words are runs without ASCII
    white space, A-Z lower-cased; fewer than ``width`` words are one shingle,
    no word none."""
    words = text.encode().translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    if len(h) < width:
        g = np.array([len(h)], np.uint64)
        for i in range(len(h)):
            g = _mix(g * _A + h[i:i + 1])
        return g
    g = h[:len(h) - width + 1].copy()
    for i in range(1, width):
        g *= _A
        g += h[i:len(h) - width + 1 + i]
    return np.unique(_mix(g))


class Bands:
    """Size bands for a threshold of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent, low = percent, [1]
        while low[-1] < 1 << 40:
            low.append(100 * low[-1] // percent + 1)
        self.low = np.array(low)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.low, size, "right")) - 1

    def ranges(self, band: int) -> tuple[int, int]:
        """Largest distance of linked sets up to this band's sizes; ranges."""
        top = 100 * int(self.low[band]) // self.percent
        k = (100 - self.percent) * 2 * top // (100 + self.percent)
        return k, k + 1 + max(2, (k + 1) // 5) if k else 0

    def signatures(self, s: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Signatures of a set in its own band and the next one (the lowest
        bit is the band's parity); for even and odd bands, how many crowded
        groups make the set deficient."""
        out, slack, band = [], [1 << 30, 1 << 30], self.of(len(s))
        mixed = _mix(s ^ _A)
        for b in (band, band + 1):
            k, n1 = self.ranges(b)
            if not n1:
                continue
            part = ((s >> np.uint64(32)) * np.uint64(n1)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            at, got = part[first], np.add.reduceat(mixed, first)
            slack[b & 1] = n1 - k - (n1 - len(first))
            if slack[b & 1] <= 0:
                empty = np.setdiff1d(np.arange(n1, dtype=np.uint64), at)
                at, got = np.concatenate([at, empty]), np.concatenate([got, np.zeros(len(empty), np.uint64)])
            sig = _mix(got ^ _mix(at + np.uint64(b << 40) + _A))
            out.append(sig & ~np.uint64(1) | np.uint64(b & 1))
        return np.concatenate(out) if out else np.zeros(0, np.uint64), slack

    def deep(self, s: np.ndarray, parity: int) -> np.ndarray:
        """Two-level signatures of a set in its own band or the next one,
        whichever has the parity."""
        band = self.of(len(s))
        band += (band & 1) != parity
        k, _ = self.ranges(band)
        n1, n2, k2 = self.levels(k)
        part = ((s >> np.uint64(32)) * np.uint64(n1 * n2)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        held = np.zeros(n1 * n2, np.uint64)
        held[part[first]] = np.add.reduceat(_mix(s ^ _A), first)
        held = _mix(held + np.arange(n1 * n2, dtype=np.uint64) * _A).reshape(n1, n2)
        left_out = np.array(list(combinations(range(n2), k2)), np.int64).reshape(-1, k2)
        rest = held.sum(axis=1, keepdims=True) - held[:, left_out].sum(axis=2)
        place = np.arange(rest.size, dtype=np.uint64).reshape(rest.shape) + np.uint64(band << 40)
        return _mix(rest ^ _mix(place)).ravel()

    @staticmethod
    def levels(k: int) -> tuple[int, int, int]:
        """(ranges, parts of a range, parts that may differ) of the choice that
        covers most of the domain, with at most max(256, 4 (k + 1)) signatures."""
        best = None
        for k2 in (1, 2, 3, 4):
            n1 = max(1, -(-(k + 1) // (k2 + 1)))
            n2 = k2 + 1
            while n2 < 16 and n1 * comb(n2 + 1, k2) <= max(256, 4 * (k + 1)):
                n2 += 1
            cover = (1 - k2 / n2) / n1
            if n1 * comb(n2, k2) <= max(256, 4 * (k + 1)) and (best is None or cover > best[0]):
                best = cover, n1, n2, k2
        return best[1:]


def _six(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _signed(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


_DOC = "doc string, text_key long, set long, n long, band long, even long, odd long"
_PACKED = f"bucket long, sig binary, fp binary, {_DOC}"
_FLAT = f"members array<long>, sig long, times long, {_DOC}"


def _packer(width: int, bands: Bands, buckets: int):
    names = [c.split()[0] for c in _PACKED.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in _PACKED.split(", ")]

    def rows(*columns):
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def pack(sigs, fps):
        s = np.concatenate(sigs)
        f = np.repeat(np.array(fps, np.uint64), [len(x) for x in sigs])
        b = ((s >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(b, kind="stable")
        s, f, b = s[order], f[order], b[order]
        cut = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]])
        for i in range(0, len(cut) - 1, 256):
            ends = list(zip(cut[i:i + 256], cut[i + 1:i + 257]))
            none = [None] * len(ends)
            yield rows([int(b[x]) for x, _ in ends], [_six(s[x:y]) for x, y in ends],
                       [f[x:y].astype("<u8").tobytes() for x, y in ends], *[none] * 7)

    def run(batches):
        cache, seen = WordHashes(), set()
        sigs, fps, held = [], [], 0
        for batch in slices(batches):
            docs = []
            for i, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                s = shingles(text, cache, width)
                fp = xxhash.xxh3_64_intdigest(s.tobytes())
                got, slack = bands.signatures(s) if len(s) else (np.zeros(0, np.uint64), [1, 1])
                docs.append((i, key, fp, len(s), bands.of(len(s)) if len(s) else 0, *slack))
                if i is None or not len(got) or fp in seen:
                    continue
                if len(seen) >= 250_000:
                    seen.clear()
                seen.add(fp)  # copies within a task send their signatures once
                sigs.append(got)
                fps.append(fp)
                held += len(got)
                if held >= PACK:
                    yield from pack(sigs, fps)
                    sigs, fps, held = [], [], 0
            if docs:
                i, key, fp, n, band, even, odd = zip(*docs)
                none = [None] * len(docs)
                at = [x % buckets for x in fp]
                yield rows(at, none, none, i, key, _signed(fp), n, band, even, odd)
        if sigs:
            yield from pack(sigs, fps)

    return run


def _groups(batches):
    """Buckets, one after another -> distinct groups of 2 to CROWD sets with
    their band's parity in sig and how often they occur, the number of crowded
    groups of a set and parity, and the documents' rows unchanged."""
    flat = pa.schema([("members", pa.list_(pa.int64())), ("sig", pa.int64()), ("times", pa.int64()), ("doc", pa.string())]
                     + [(c, pa.int64()) for c in ("text_key", "set", "n", "band", "even", "odd")])

    def of(bucket, sigs, fps):
        s = _from_six(b"".join(sigs))
        f = np.frombuffer(b"".join(fps), "<u8")
        order = np.lexsort((f, s))
        s, f = s[order], f[order]
        new = np.concatenate([[True], (s[1:] != s[:-1]) | (f[1:] != f[:-1])])
        s, f = s[new], f[new]
        start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        size = np.diff(np.append(start, len(s)))
        small = Counter((_signed(f[a:a + n]).tobytes(), int(s[a] & np.uint64(1))) for a, n in zip(start, size) if 1 < n <= CROWD)
        if small:
            values = [np.frombuffer(x, np.int64) for x, _ in small]
            ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))
            yield pa.record_batch([column, pa.array([odd for _, odd in small]), pa.array(list(small.values()))]
                                  + [pa.nulls(len(small), t.type) for t in list(flat)[3:]], schema=flat)
        crowded = np.repeat(size > CROWD, size)
        if crowded.any():
            key, times = np.unique(np.stack([_signed(f[crowded]), (s[crowded] & np.uint64(1)).astype(np.int64)], axis=1),
                                   axis=0, return_counts=True)
            cols = [pa.nulls(len(key), t.type) for t in flat]
            cols[1], cols[2], cols[5] = pa.array(key[:, 1]), pa.array(times), pa.array(key[:, 0])
            yield pa.record_batch(cols, schema=flat)

    at, sigs, fps = None, [], []
    for batch in batches:
        is_doc = pc.is_null(batch.column("sig"))
        docs = batch.filter(is_doc)
        if docs.num_rows:
            yield pa.record_batch([pa.nulls(docs.num_rows, t.type) if t.name in ("members", "sig", "times") else docs.column(t.name)
                                   for t in flat], schema=flat)
        rest = batch.filter(pc.invert(is_doc))
        for some in slices([rest]):
            for bucket, s, f in zip(*(some.column(c).to_pylist() for c in ("bucket", "sig", "fp"))):
                if bucket != at:
                    if sigs:
                        yield from of(at, sigs, fps)
                    at, sigs, fps = bucket, [], []
                sigs.append(s)
                fps.append(f)
    if sigs:
        yield from of(at, sigs, fps)


def join_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (set, comp) after joining the components that ``links``
    (a, b: components) connect; each takes its smallest member. Components are
    hooked to their smallest neighbour and paths halved until no link between
    different components is left."""
    total = None
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "parents")
        while True:
            jump = written(up.join(up.select(F.col("a").alias("p"), F.col("p").alias("q")), "p")
                           .select("a", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), "parents")
            up = jump.select("a", "p")
            if jump.where("moved").isEmpty():
                break
        to = lambda c, n: up.select(F.col("a").alias(c), F.col("p").alias(n))
        edges = written(edges.join(to("a", "x"), "a").join(to("b", "y"), "b").where("x <> y")
                        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        total = up if total is None else written(
            total.join(to("p", "q"), "p", "left").select("a", F.coalesce("q", "p").alias("p"))
            .union(up.join(total.select("a"), "a", "left_anti").select("a", "p")), "roots")
    if total is None:
        return labels
    return written(labels.join(total.select(F.col("a").alias("comp"), "p"), "comp", "left")
                   .select("set", F.coalesce("p", "comp").alias("comp")), "labels")


def _compare(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (set, pivot, a, b) whose Jaccard similarity reaches the threshold,
    with a and b kept. A pivot's text is sent once to each of up to 16 tasks
    and its partners pass by one at a time."""
    part = F.pmod(F.xxhash64("set"), F.lit(16))
    dealt = pairs.withColumn("part", part)
    mine = dealt.join(texts, "set").select("pivot", "part", F.lit(1).alias("kind"), "a", "b", "z")
    lead = (dealt.select(F.col("pivot").alias("set"), "part").distinct().join(texts, "set")
            .select(F.col("set").alias("pivot"), "part", F.lit(0).alias("kind"),
                    F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), "z"))

    def check(batches):
        cache, plain = WordHashes(), zstandard.ZstdDecompressor()
        read = lambda z: shingles(plain.decompress(z).decode(), cache, width)
        for batch in batches:
            a, b = [], []
            for kind, x, y, z in zip(*(batch.column(c).to_pylist() for c in ("kind", "a", "b", "z"))):
                if kind == 0:
                    check.pivot = read(z)
                    continue
                s, p = read(z), check.pivot
                shared = len(np.intersect1d(s, p, assume_unique=True))
                if 100 * shared >= percent * (len(s) + len(p) - shared):
                    a.append(x)
                    b.append(y)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (lead.union(mine).repartition("pivot", "part").sortWithinPartitions("pivot", "part", "kind")
            .mapInArrow(check, "a long, b long"))


def _deep_packer(width: int, bands: Bands, buckets: int):
    def run(batches):
        cache, plain = WordHashes(), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sigs, fps, comps = [], [], []
                for fp, comp, in0, in1, z in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    s = shingles(plain.decompress(z).decode(), cache, width)
                    for parity in (0, 1):
                        if (in0, in1)[parity]:
                            sigs.append(bands.deep(s, parity))
                            fps.append(fp)
                            comps.append(comp)
                if not sigs:
                    continue
                sizes = [len(x) for x in sigs]
                s, f, c = np.concatenate(sigs), np.repeat(np.array(fps), sizes), np.repeat(np.array(comps), sizes)
                b = ((s >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order = np.argsort(b, kind="stable")
                s, f, c, b = s[order], f[order], c[order], b[order]
                cut = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]])
                ends = list(zip(cut[:-1], cut[1:]))
                yield pa.record_batch([pa.array([int(b[x]) for x, _ in ends], pa.int64()),
                                       pa.array([_six(s[x:y]) for x, y in ends], pa.binary())]
                                      + [pa.array([v[x:y].astype("<i8").tobytes() for x, y in ends], pa.binary()) for v in (f, c)],
                                      names=["bucket", "sig", "fp", "comp"])

    return run


def _open_groups(batches):
    """Buckets, one after another -> (set, its component, pivot, the pivot's
    component) of all places in groups that hold several components; the pivot
    is the group's smallest set."""

    def of(sigs, fps, comps):
        s, f, c = _from_six(b"".join(sigs)), np.frombuffer(b"".join(fps), "<i8"), np.frombuffer(b"".join(comps), "<i8")
        order = np.lexsort((f, s))
        s, f, c = s[order], f[order], c[order]
        start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        size = np.diff(np.append(start, len(s)))
        used = np.repeat(np.minimum.reduceat(c, start) != np.maximum.reduceat(c, start), size)
        first = np.repeat(start, size)[used]
        return f[used], c[used], f[first], c[first]

    now, held = None, ([], [], [])
    for batch in batches:
        for bucket, *row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if bucket != now:
                if held[0]:
                    yield of(*held)
                now, held = bucket, ([], [], [])
            for h, v in zip(held, row):
                h.append(v)
    if held[0]:
        yield of(*held)


def _leads(batches):
    """Buckets -> (set, pivot) for the sets of open groups, each once a bucket:
    with its smallest pivot of another component, or itself where it has none."""
    for f, c, pivot, other in _open_groups(batches):
        sets, at = np.unique(f, return_inverse=True)
        least = sets.copy()
        np.minimum.at(least, at, np.where(c != other, pivot, f))
        if len(sets):
            yield pa.record_batch([pa.array(sets), pa.array(least)], names=["set", "pivot"])


def _families(batches):
    """Buckets -> (set, pivot) for the sets of open groups, each once a bucket:
    with the smallest set that the bucket's open groups connect it to."""
    for f, _, pivot, _ in _open_groups(batches):
        sets, ends = np.unique(np.concatenate([f, pivot]), return_inverse=True)
        a, b = ends[:len(f)], ends[len(f):]
        root, met = np.arange(len(sets)), len(sets) > 0
        while met:
            least = np.minimum(root[a], root[b])
            up = root.copy()
            np.minimum.at(up, root[a], least)
            np.minimum.at(up, root[b], least)
            while (up[up] != up).any():
                up = up[up]
            root, met = up, (up != root).any()
        if len(sets):
            yield pa.record_batch([pa.array(sets), pa.array(sets[root])], names=["set", "pivot"])


def _block_linker(width: int, percent: int):
    """Rows (family, i, j, block, comp, z), a pair of blocks after another ->
    links (a, b) that join components."""

    def of(same, blocks, comps, zs, cache, plain):
        sets = [shingles(plain.decompress(z).decode(), cache, width) for z in zs]
        size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        _, rank = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(rank, kind="stable")
        posted, ends = owner[order], np.concatenate([[0], np.cumsum(np.bincount(rank))])
        side, at = np.array(blocks), np.concatenate([[0], np.cumsum(size)])
        up = {c: c for c in comps}

        def find(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        out = []
        for k in range(len(sets)):
            r = rank[at[k]:at[k + 1]]
            n = ends[r + 1] - ends[r]
            ahead = np.cumsum(n) - n
            shared = np.bincount(posted[np.repeat(ends[r] - ahead, n) + np.arange(n.sum())], minlength=len(sets))
            linked = 100 * shared >= percent * (size[k] + size - shared)
            linked[:k + 1] = False
            if not same:
                linked &= side != side[k]
            for x in np.flatnonzero(linked):
                a, b = find(comps[k]), find(comps[x])
                if a != b:
                    up[max(a, b)] = min(a, b)
                    out.append((comps[k], comps[x]))
        return pa.record_batch([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def run(batches):
        cache, plain = WordHashes(), zstandard.ZstdDecompressor()
        now, held = None, ([], [], [])
        for batch in batches:
            for family, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (family, i, j) != now:
                    if held[0]:
                        yield of(now[1] == now[2], *held, cache, plain)
                    now, held = (family, i, j), ([], [], [])
                for h, v in zip(held, row):
                    h.append(v)
        if held[0]:
            yield of(now[1] == now[2], *held, cache, plain)

    return run


def _family_links(ties: DataFrame, sizes: DataFrame, labels: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    own = ties.select("set").union(ties.select("pivot")).distinct().select("set", F.col("set").alias("comp"))
    family = join_labels(written(own, "open-sets"), ties.select(F.col("set").alias("a"), F.col("pivot").alias("b")))
    sized = family.withColumnRenamed("comp", "family").join(sizes, "set")
    blocks = written(sized.groupBy("family").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks")), "families")
    dealt = (sized.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return (dealt.join(labels, "set").join(texts, "set").select(
        "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "comp", "z")
        .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
        .mapInArrow(_block_linker(width, percent), "a long, b long"))


def _squeezed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, text_key, z) of the rows whose text may be wanted, compressed before
    they are shuffled. A bitmap of 2 MB over hashes of text_key, whatever the
    input, leaves out most others; it lets all wanted rows pass."""
    bits = 1 << 24
    at = F.pmod("text_key", F.lit(bits)) + 1
    marked = np.zeros(bits // 8, np.uint8)
    for r in wanted.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("b")).collect():  # 512 rows of 4 KB at most
        marked[(r.k - 1) * 4096:r.k * 4096] = np.frombuffer(r.b, np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(marked)

    @F.pandas_udf("binary")
    def squeezed(key, text):
        c, k = zstandard.ZstdCompressor(level=1), key.to_numpy() % bits
        held = (shared.value[k >> 3] >> (k & 7)) & 1
        return pd.Series([c.compress(t.encode()) if h else None for t, h in zip(text, held)])

    return rows.select("doc", "text_key", squeezed("text_key", "text").alias("z")).where("z is not null")


def _candidates(groups: DataFrame, needs: DataFrame) -> DataFrame:
    """Pairs (pivot < set) that share as many signatures of groups as both
    need in the band of the larger set."""

    def pairs(batches):
        for batch in batches:
            a, b, odd, times = [], [], [], []
            for m, o, t in zip(*(batch.column(c).to_pylist() for c in ("members", "parity", "times"))):
                m = np.array(m)
                x, y = np.triu_indices(len(m), 1)
                a.append(m[x])
                b.append(m[y])
                odd.append(np.full(len(x), o))
                times.append(np.full(len(x), t))
                if sum(map(len, a)) > 200_000:
                    yield table(a, b, odd, times)
                    a, b, odd, times = [], [], [], []
            if a:
                yield table(a, b, odd, times)

    def table(*columns):
        return pa.record_batch([pa.array(np.concatenate(c)) for c in columns], names=["pivot", "set", "parity", "times"])

    once = groups.groupBy("members", F.col("sig").alias("parity")).agg(F.sum("times").alias("times"))
    shared = (once.mapInArrow(pairs, "pivot long, set long, parity long, times long")
              .groupBy("pivot", "set", "parity").agg(F.sum("times").alias("times")))
    need = lambda k: F.when(F.col("parity") == 0, F.col("need0")).otherwise(F.col("need1")).alias(k)
    mine = shared.join(needs, "set").select("pivot", "set", "parity", "times", F.col("band").alias("band_a"), need("need_a"))
    both = mine.join(needs.withColumnRenamed("set", "pivot"), "pivot").select("*", need("need_b"))
    return both.where((F.greatest("band", "band_a") % 2 == F.col("parity")) & (F.col("times") >= F.greatest("need_a", "need_b"))
                      ).select("pivot", "set")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id of every row of ``docs``.

    Two documents link when 100 * |intersection| >= percent * |union|;
    component_id is the smallest id reachable by links, the own id included.
    Equal sets always link. Empty sets (null or blank texts) link with nothing.
    A row without id gets no component and links nothing. Rows may repeat;
    rows of one id with different texts are joined through the id only where
    their texts link. An empty table gives an empty result.
    """
    spark, id_type, bands = docs.sparkSession, docs.schema[id_col].dataType, Bands(percent)
    rows = docs.select(F.col(id_col).cast("string").alias("doc"), F.xxhash64(text_col).alias("text_key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    buckets = max(64, docs.count() // 256)
    pack = _packer(width, bands, buckets)
    packed = rows.mapInArrow(lambda b: released(pack(b)), _PACKED)
    flat = written(packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: released(_groups(b)), _FLAT), "groups")
    seen = flat.where("n is not null").select("doc", "text_key", "set", "n", "band", "even", "odd")
    ident = F.col("doc").cast(id_type)
    classes = written(seen.where("doc is not null and n > 0").groupBy("set").agg(
        F.min(F.struct(ident.alias("id"), "doc", "text_key")).alias("rep"), *[F.min(c).alias(c) for c in ("n", "band", "even", "odd")])
        .select("set", "rep.*", "n", "band", "even", "odd"), "sets")

    crowd = flat.where("members is null and sig is not null")
    met = crowd.groupBy("set").agg(F.sum(F.when(F.col("sig") == 0, F.col("times"))).alias("c0"),
                                   F.sum(F.when(F.col("sig") == 1, F.col("times"))).alias("c1"))
    needs = written(classes.join(met, "set", "left").select(
        "set", "band", (F.col("even") - F.coalesce("c0", F.lit(0))).alias("need0"),
        (F.col("odd") - F.coalesce("c1", F.lit(0))).alias("need1")), "needs")
    lacking = written(needs.where("need0 <= 0 or need1 <= 0").select(
        "set", (F.col("need0") <= 0).alias("in0"), (F.col("need1") <= 0).alias("in1")), "deficient")
    candidates = written(_candidates(flat.where("members is not null"), needs), "candidates")
    involved = (candidates.select(F.explode(F.array("pivot", "set")).alias("set")).union(lacking.select("set"))).distinct()
    labels = written(involved.select("set", F.col("set").alias("comp")), "labels")

    reps = written(involved.join(classes, "set").select("set", "doc", "text_key"), "reps")
    texts = written(_squeezed(rows.where("doc is not null"), reps).join(reps, ["doc", "text_key"])
                    .groupBy("set").agg(F.first("z").alias("z")), "texts")

    def compare(pairs: DataFrame) -> DataFrame:
        return join_labels(labels, _compare(written(pairs, "pairs"), texts, width, percent))

    own = F.col("set").alias("a"), F.col("pivot").alias("b")
    labels = compare(candidates.groupBy("set").agg(F.min("pivot").alias("pivot")).select("set", "pivot", *own))
    side = labels.select(F.col("set").alias("pivot"), F.col("comp").alias("b"))
    labels = compare(candidates.join(labels.withColumnRenamed("comp", "a"), "set").join(side, "pivot")
                     .where("a <> b").select("set", "pivot", "a", "b"))
    def open_groups(some: DataFrame, rows) -> DataFrame:
        """``rows`` (_leads, _families) of the groups of the deficient sets ``some``."""
        shares = max(16, some.count() // 256)
        packed = (some.join(texts, "set").join(labels, "set").select("set", "comp", "in0", "in1", "z")
                  .mapInArrow(_deep_packer(width, bands, shares), "bucket long, sig binary, fp binary, comp binary"))
        return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(rows, "set long, pivot long")

    def compare_apart(pairs: DataFrame) -> DataFrame:
        side = labels.select(F.col("set").alias("pivot"), F.col("comp").alias("b"))
        apart = pairs.join(labels.withColumnRenamed("comp", "a"), "set").join(side, "pivot").where("a <> b")
        return compare(apart.select("set", "pivot", "a", "b"))

    for _ in range(LEADS):
        leads = written(open_groups(lacking, _leads).groupBy("set").agg(F.min("pivot").alias("pivot")), "leads")
        if leads.isEmpty():
            break
        labels = compare_apart(leads)
        lacking = lacking.join(leads, "set", "left_semi")
    else:
        members = written(open_groups(lacking, _families).distinct(), "members")
        labels = join_labels(labels, _family_links(members, classes.select("set", "n"), labels, texts, width, percent))

    least = written(classes.join(labels, "set", "left").select("set", "id", F.coalesce("comp", "set").alias("comp")), "sets")
    smallest = written(least.groupBy("comp").agg(F.min("id").alias("component_id")), "smallest")
    of = written(least.join(smallest, "comp").select("set", "component_id"), "components")
    out = seen.select(ident.alias(id_col), "n", F.when(F.col("doc").isNotNull() & (F.col("n") > 0), F.col("set")).alias("set"))
    return out.join(of, "set", "left").select(
        id_col, F.col("n").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col(id_col)).otherwise(F.col("component_id")).alias("component_id"))
