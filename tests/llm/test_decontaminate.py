import pickle
import random

import numpy as np
import pytest

from churnlens.llm import decontaminate as d
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randint(9, 60)) + ". " + prose(rng, rng.randint(3, 9)) + ".") for i in range(60)]
    items += [(60, None), (61, ""), (5, items[5][1]), (62, "!!!")]
    planted = {}
    docs = []
    for i in range(200):
        t = prose(rng, rng.randint(0, 400))
        if i % 9 == 0:
            k = rng.randrange(60)
            body = items[k][1]
            t = f"{t} {body.upper() if i % 2 else body.replace(' ', '*** ')} {prose(rng, 30)}"
            planted[i] = k
        docs.append((i, t))
    docs += [(300, None), (301, ""), (None, items[7][1])]
    return (spark.createDataFrame([(*x, 1.0) for x in docs], "doc_id long, text string, score double").repartition(4),
            spark.createDataFrame([(*x, "c") for x in items], "item_id long, text string, id string"), docs, items, planted)


def brute(docs, items, share=0.5, overlap=0.6):
    """All passages against all items, no pruning."""
    used = [(i, t) for i, t in items if t and d.words(t)]
    df = {}
    for _, t in used:
        for w in set(d.words(t)):
            df[w] = df.get(w, 0) + 1
    mean = float(np.mean([len(d.words(t)) for _, t in used]))
    longest = {}
    for _, t in used:
        n = len(d.words(t))
        c = max(2, (n - 1).bit_length() // 2)
        longest[c] = max(n, longest.get(c, 0))
    out = set()
    for item, t in used:
        own = d.words(t)
        weight = {w: np.log(1 + (len(used) - df[w] + .5) / (df[w] + .5)) * own.count(w) * 2.2
                  / (own.count(w) + 1.2 * (.25 + .75 * len(own) / mean)) for w in set(own)}
        step = longest[max(2, (len(own) - 1).bit_length() // 2)]
        for i, text in docs:
            ws = d.words(text or "")
            for a in range(0, max(1, len(ws) - step), step):
                part = ws[a:a + 2 * step]
                if sum(weight.get(w, 0) for w in set(part)) >= share * sum(weight.values()) - 1e-9 and all(
                        sum(any(tuple(part[k:k + len(y)]) == y for k in range(len(part))) for y in x) >= overlap * len(x) - 1e-12
                        for x in map(d.runs, d.question_and_answer(t))):
                    out.add((i, item))
    return out


@pytest.mark.parametrize("items", [1024, 20])
def test_hits(case, monkeypatch, items):
    monkeypatch.setattr(d, "PASS_ITEMS", items)
    docs, bench, rows, texts, planted = case
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()}
    assert got == brute(rows, texts)
    assert planted.items() <= got and (None, 7) in got
    assert {i for i, _ in got} == {*planted, None}
    clean = {r.doc_id for r in d.clean(docs, bench).collect()}
    assert clean == {i for i, _ in rows if i is not None} - planted.keys()
    assert d.clean(docs, bench).columns == docs.columns


def test_empty(case):
    docs, bench, rows, _, _ = case
    assert d.contaminated(docs.where("false"), bench).count() == 0
    assert d.contaminated(docs, bench.where("false")).count() == 0
    assert d.clean(docs, bench.where("false")).count() == len(rows)


def test_edited_items_of_common_words(spark):
    """The shortest contiguous runs, and the cheapest scattered ones, that pass
    the overlap checks are hits whatever their score."""
    rng = random.Random(3)
    pool = [f"c{k}" for k in range(40)]
    items, docs = [], []
    for i in range(40):
        q = [rng.choice(pool) for _ in range(16)] + [f"q{i}x{k}" for k in range(8)]
        items.append((i, f"{' '.join(q)}. same closing words of all r{i}a r{i}b r{i}c."))
        docs.append((i, " ".join(q[:16]) + " other text same closing words of all r%da" % i))
        cut = [w for k, w in enumerate(q) if k != 20]
        docs.append((100 + i, " ".join(cut[:17]) + " here closing words of all r%da r%db" % (i, i)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == brute(docs, items, share=0)
    assert {(i, i) for i in range(40)} | {(100 + i, i) for i in range(40)} <= got
    assert got - brute(docs, items, share=0.6) and got - brute(docs, items, share=0.5)
    assert d.clean(spark.createDataFrame(docs, "doc_id long, text string"), bench).count() == 0


def _index(rng, n, vocabulary, length):
    pool = [f"w{k}" for k in range(vocabulary)]
    texts = [" ".join(pool[int(len(pool) * rng.random() ** 3)] for _ in range(length)) + ". The end." for _ in range(n)]
    df = {}
    for t in texts:
        for w in set(d.words(t)):
            df[w] = df.get(w, 0) + 1
    return texts, d.Index(list(enumerate(texts)), df, n, float(length + 2), 0.5, 0.6)


def test_a_large_index_is_small_and_skips_blocks():
    rng = random.Random(4)
    texts, index = _index(rng, 1024, 60_000, 150)
    assert len(pickle.dumps(index)) < 20 << 20 and len(index.term) > 20_000
    docs = [" ".join(rng.choice(texts).split()[20:100]) for _ in range(150)] + texts[:50]
    ids = [np.array([index.term[w] for w in d.words(t)]) for t in docs]
    found = index.hits(docs, ids, 0.6)
    assert all(k in f for k, f in enumerate(found[150:]))
    assert index.skipped > 0.9 * index.met > 0  # postings of most blocks stay unread


@pytest.mark.parametrize("entries", [1, 700, 500_000])
def test_walk_retrieves_all_above_their_thresholds(monkeypatch, entries):
    monkeypatch.setattr(d, "ENTRIES", entries)
    rng = random.Random(6)
    texts, index = _index(rng, 90, 200, 30)
    docs = [" ".join(rng.choice(texts).split()[:rng.randint(5, 30)] + [f"w{rng.randrange(200)}" for _ in range(60)]) for _ in range(40)] + [""]
    ids = [np.array([index.term.get(w, -1) for w in d.words(t)], np.int64) for t in docs]
    dense = np.zeros((len(index.term), 90))
    for t in range(len(index.term)):
        for e in range(index.entry[t], index.entry[t + 1]):
            p = slice(index.posting[e], index.posting[e + 1])
            dense[t, index.col[p]] = index.weight[p]
    want = set()
    for k, i in enumerate(ids):
        for w in range(index.windows(len(i))):
            part = i[w * index.longest:(w + 2) * index.longest]
            score = dense[np.unique(part[part >= 0])].sum(axis=0)
            want |= {(k, w * index.longest, int(c)) for c in np.flatnonzero(score >= index.needed - 1e-9)}
    assert {x[:3] for x in index.candidates(ids)} == want and want


def test_repeated_documents_and_a_very_long_text(spark):
    """An item is found at the end of 300,000 words, and in each repeated row."""
    rng = random.Random(12)
    item = prose(rng, 40) + ". " + prose(rng, 6) + "."
    long = prose(rng, 1000) + " "
    docs = [(1, item), (1, item), (2, long * 300 + item), (3, long * 300), (1, long)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, prose(rng, 30) + ". " + prose(rng, 5) + ".")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in d.contaminated(table, bench).collect()) == [(1, 7), (1, 7), (2, 7)]
    assert sorted((r.doc_id, len(r.text)) for r in d.clean(table, bench).collect()) == sorted([(1, len(long)), (3, len(long) * 300)])
