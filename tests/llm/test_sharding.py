import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

from churnlens.llm import sharding
from churnlens.sources.fixtures import read_table


def check(docs, shards=8):
    got = sharding.shard(docs, shards).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_every_row_once(docs):
    check(docs)


def test_sizes_near_equal_and_equal_texts_together(spark):
    docs = read_table(spark, "/root/testdata/sf0.1", "documents")
    got = check(docs)
    size = np.bincount([r.shard for r in got], [r.size for r in got], 8)
    assert size.max() / size.min() < 1.01
    rows = np.bincount([r.shard for r in got], minlength=8)
    assert rows.max() / rows.min() < 1.1
    text = {r.doc_id: r.text for r in docs.collect()}
    at = defaultdict(set)
    for r in got:
        at[text[r.doc_id]].add(r.shard)
    assert max(map(len, at.values())) == 1


def test_group_larger_than_a_shard_is_split(spark):
    docs = spark.createDataFrame([(i, "same text " * 20) for i in range(4000)] + [(5000 + i, f"other {i} " * 15) for i in range(2000)],
                                 "doc_id long, text string")
    got = check(docs)
    size = np.bincount([r.shard for r in got], [r.size for r in got], 8)
    assert size.max() / size.min() < 1.3


def test_place_prefers_the_residual_direction():
    at = sharding.place(np.array([[.5, 0, 0], [.5, 0, 0], [.25, .5, 0], [.25, .5, 0]]), 2)
    assert sorted(at[:2]) == [0, 1] and sorted(at[2:]) == [0, 1]


def test_empty(empty):
    assert sharding.shard(empty).count() == 0


def test_against_brute_force(spark):
    """Groups of over 1 / 512 of a shard: each placed by decreasing size where
    the dot product with the residual is highest, slots in order of unit and id."""
    rng = random.Random(4)
    texts = [f"{k} " + " ".join("x" * rng.randint(1, 12) for _ in range(rng.randint(20, 300))) for k in range(90)]
    rows = list(enumerate(t for t in texts for _ in range(rng.randint(1, 9)))) + [(900, None), (901, "")]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    size = {t: (len(ids) * (len(t) + 1), len(ids) * len(t.split()), len(ids)) for t, ids in groups.items()}
    cap = [max(1, sum(v[k] for v in size.values())) / 4 for k in range(3)]
    share = {t: [v[k] / cap[k] for k in range(3)] for t, v in size.items()}
    assert all(1 / 512 < max(v) and v[0] < 1 for v in share.values())
    unit = {t: hashlib.md5(t.encode()).hexdigest() + "/0" for t in groups}
    left, at = [[1.0] * 3 for _ in range(4)], {}
    for t in sorted(groups, key=lambda t: (-max(share[t]), unit[t])):
        fits = [s for s in range(4) if left[s][0] >= share[t][0] - 1e-12]
        at[t] = (max(fits, key=lambda s: (sum(a * b for a, b in zip(left[s], share[t])), -s)) if fits
                 else max(range(4), key=lambda s: (left[s][0], -s)))
        left[at[t]] = [a - b for a, b in zip(left[at[t]], share[t])]
    want = {}
    for s in range(4):
        inside = sorted((unit[t], i) for t, ids in groups.items() if at[t] == s for i in ids)
        want |= {i: (s, k) for k, (_, i) in enumerate(inside)}
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want


def test_ties_of_slots_and_very_long_texts(spark):
    rows = [(1, "same"), (1, "same"), (1, "same"), (2, "w " * 2_000_000), (3, "é" * 1_000_000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 3)
