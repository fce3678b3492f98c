import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from churnlens.llm import jaccard_join
from churnlens.llm.common import ASCII_LOWER
from churnlens.llm.jaccard_join import Bands, WordHashes, jaccard_components, shingles
from tests.llm.conftest import prose


def word_set(text, width=5):
    w = (text or "").encode().translate(ASCII_LOWER).split()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, percent=80):
    sets = [(i, word_set(t)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            up[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(i if i is None else find(i))) for i, s in sets)


def result(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize("crowd", [16, 2])
def test_components(docs, monkeypatch, crowd):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    assert result(jaccard_components(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("crowd,block", [(48, 500_000), (3, 500_000), (3, 900)])
def test_chains_and_large_groups(spark, monkeypatch, crowd, block):
    """Chains of near copies, whose ends don't link, and a group around one text."""
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng, rows = random.Random(3), []
    for size in (7, 25, 90):
        words = [f"w{rng.randrange(400)}" for _ in range(size)]
        for k in range(24):
            rows.append(" ".join(words))
            words[(k * 7) % size] = f"n{k}"
        center = [f"c{rng.randrange(400)}" for _ in range(size)]
        for _ in range(40):
            w = list(center)
            for _ in range(rng.randrange(1 + size // 40)):
                w[rng.randrange(size)] = f"e{rng.randrange(9999)}"
            rows.append(" ".join(w))
    rng.shuffle(rows)
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(6)
    assert result(jaccard_components(table)) == brute(list(enumerate(rows)))


@pytest.mark.parametrize("rows", [jaccard_join._leads, jaccard_join._families])
def test_a_set_gives_one_row_a_bucket(rows):
    """Groups of a bucket with many pivots each: a row a set, not one a pivot.
    Sets 0..59 meet in 30 groups, 100 and 101 in one of their own, and the group
    of 200 and 201 is of one component."""
    groups = [sorted({k, *range(k, 60, 2)}) for k in range(30)] + [[100, 101], [200, 201]]
    comp = {**{i: i for g in groups for i in g}, 201: 200, 30: 28}
    sig = np.repeat(np.arange(len(groups), dtype=np.uint64), [len(g) for g in groups])
    sets = np.concatenate(groups)
    parts = [(jaccard_join._six(sig[x]), sets[x].astype("<i8").tobytes(), np.array([comp[i] for i in sets[x]], "<i8").tobytes())
             for x in (slice(0, 400), slice(400, None))]
    batch = pa.record_batch([pa.array([7, 7]), *[pa.array(c, pa.binary()) for c in zip(*parts)]], names=["bucket", "sig", "fp", "comp"])
    got = [p for b in rows([batch]) for p in zip(*(c.to_pylist() for c in b.columns))]
    want = {i: i % 2 for i in range(60)} | {100: 100, 101: 100}
    assert sorted(got) == sorted(want.items())


def test_signatures_lose_no_linked_pair():
    """Linked sets share a signature of a range that is not empty, or both
    carry signatures of empty ranges."""
    rng, bands = np.random.default_rng(1), Bands(80)
    for _ in range(1500):
        n = int(rng.integers(1, 60)) if rng.random() < 0.6 else int(rng.integers(60, 900))
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        most = (20 * 2 * len(a)) // 180
        drop = int(rng.integers(0, most + 1))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[drop:]], rng.integers(0, 2 ** 64, int(rng.integers(0, most - drop + 1)), dtype=np.uint64)]))
        same = len(np.intersect1d(a, b))
        if not len(b) or 100 * same < 80 * (len(a) + len(b) - same) or np.array_equal(a, b):
            continue
        assert len(np.intersect1d(bands.signatures(a)[0], bands.signatures(b)[0])), (len(a), len(b), same)


def test_deep_signatures_lose_no_linked_pair():
    rng, bands = np.random.default_rng(2), Bands(80)
    for _ in range(800):
        n = int(rng.integers(4, 60)) if rng.random() < 0.7 else int(rng.integers(60, 600))
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        most = (20 * 2 * len(a)) // 180
        drop = int(rng.integers(0, most + 1))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[drop:]], rng.integers(0, 2 ** 64, int(rng.integers(0, most - drop + 1)), dtype=np.uint64)]))
        same = len(np.intersect1d(a, b))
        if 100 * same < 80 * (len(a) + len(b) - same):
            continue
        parity = max(bands.of(len(a)), bands.of(len(b))) & 1
        assert len(np.intersect1d(bands.deep(a, parity), bands.deep(b, parity))), (len(a), len(b), same)


def test_shingles_are_the_word_sets(texts):
    cache = WordHashes()
    for t in texts:
        assert len(shingles(t or "", cache, 5)) == len(word_set(t))


def test_empty(empty):
    assert jaccard_components(empty).count() == 0


def test_near_copies_of_one_text_need_no_blocks(spark, monkeypatch):
    """Each is within reach of the group's smallest set, so none is left for the
    comparison of all with all."""
    from churnlens.llm import jaccard_join as jj
    monkeypatch.setattr(jj, "_family_links", lambda *a: (_ for _ in ()).throw(AssertionError("blocks")))
    rng = random.Random(21)
    base = prose(rng, 120).split()
    rows = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w)))
    got = jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 150


def test_rows_of_one_id_with_different_texts(spark):
    """Each row follows its own text; the id alone joins nothing."""
    rng = random.Random(8)
    a, b = prose(rng, 60), prose(rng, 60)
    table = spark.createDataFrame([(5, a), (3, a), (5, b), (4, b), (5, a)], "doc_id long, text string")
    n = len(word_set(a)), len(word_set(b))
    assert result(jaccard_components(table)) == sorted(
        [("5", n[0], "3"), ("5", n[0], "3"), ("3", n[0], "3"), ("5", n[1], "4"), ("4", n[1], "4")])
