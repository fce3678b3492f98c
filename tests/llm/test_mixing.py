import hashlib
from collections import defaultdict

import pytest

from churnlens.llm import mixing


def water(budget, caps, weights):
    """Shares by bisection."""
    if sum(caps.values()) <= budget:
        return dict(caps)
    lo, hi = 0.0, 1e18
    for _ in range(300):
        mid = (lo + hi) / 2
        if sum(min(caps[k], weights[k] * mid) for k in caps) > budget:
            hi = mid
        else:
            lo = mid
    return {k: min(caps[k], weights[k] * lo) for k in caps}


def brute(rows, weights, share, epochs, seed):
    leaves = defaultdict(list)
    for i, d, lang, s, t in rows:
        leaves[d or "none", lang or "none", s or "none"].append((i, t or 0))
    w = lambda level, k: weights.get(level, {}).get(k, 1.0)
    tokens = {k: sum(t for _, t in v) for k, v in leaves.items()}
    cap = {k: t * epochs for k, t in tokens.items() if t and w("domain", k[0]) and w("lang", k[1]) and w("source", k[2])}
    got = {(): share * sum(tokens.values())}
    for depth, level in enumerate(mixing.LEVELS, 1):
        for parent in [p for p in got if len(p) == depth - 1]:
            kids = defaultdict(float)
            for k, c in cap.items():
                if k[:depth - 1] == parent:
                    kids[k[:depth]] += c
            got |= water(got[parent], kids, {k: w(level, k[-1]) for k in kids})
    out = []
    for k in cap:
        whole, rest = divmod(int(got[k] + 1e-6), tokens[k])
        out += [(i, e, *k) for e in range(whole) for i, _ in leaves[k]]
        done = 0
        for i, t in sorted(leaves[k], key=lambda x: (hashlib.md5(f"{seed}:{whole}:{x[0]}".encode()).hexdigest(), x)):
            if done >= rest:
                break
            out.append((i, whole, *k))
            done += t
    return out


@pytest.mark.parametrize("share,epochs,bucket", [(0.5, 1, 4096), (0.5, 1, 3), (0.8, 2, 7), (3.0, 2, 5), (0.0, 1, 5), (1.0, 1, 2)])
def test_against_brute_force(spark, monkeypatch, share, epochs, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    rows = [(i, None if i % 13 == 0 else f"d{i % 3}", "en" if i % 5 else "de", None if i % 17 == 0 else f"s{i * i % 7}",
             None if i % 19 == 0 else (i * 37) % 50) for i in range(300)]
    weights = {"domain": {"d0": 5.0, "d1": 1.0, "d2": 0.0}, "lang": {"en": 1.0, "de": 3.0}, "source": {"s1": 4.0}}
    table = spark.createDataFrame([(*r, "clash") for r in rows], "id long, domain string, lang string, source string, tokens long, budget string")
    got = [(r.id, r.epoch, r.domain, r.lang, r.source) for r in mixing.mix(table, weights, share, epochs, 3).collect()]
    assert sorted(got) == sorted(brute(rows, weights, share, epochs, 3))


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10, 1), ("a", "x", "s2", 500, 1), ("a", "y", "s3", 500, 1), ("b", "x", "s4", 1000, 1)],
                                   "domain string, lang string, source string, tokens long, n long")
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, {}, 400 / 2010, 1).collect()}
    # b has its half; a's half is shared by x and y; s1's shortage of 40 goes to s2 alone
    assert got == {"s1": 10, "s2": 90, "s3": 100, "s4": 200}


def test_documents(docs, empty):
    from pyspark.sql import functions as F
    rows = mixing.document_rows(docs, F.length("text"))
    assert mixing.mix(rows, mixing.WEIGHTS, 0.7, 1, 1).count() > 0
    assert mixing.mix(mixing.document_rows(empty, F.length("text")), mixing.WEIGHTS, 0.7).count() == 0


def test_repeated_ids_follow_their_tokens(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 4)
    rows = [(i // 3, f"d{i % 2}", "en", f"s{i % 4}", 5 + (i * 7) % 23) for i in range(120)]
    rows += rows[:10]
    table = spark.createDataFrame(rows, "id long, domain string, lang string, source string, tokens long")
    got = [(r.id, r.epoch, r.domain, r.lang, r.source) for r in mixing.mix(table, {}, 0.45, 1, 5).collect()]
    assert sorted(got) == sorted(brute(rows, {}, 0.45, 1, 5))
