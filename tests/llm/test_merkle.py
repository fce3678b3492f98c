import hashlib
import zlib

import pytest

from churnlens.llm.merkle import DEPTH, FAN, H, PersistentTree, fold, newline_tampering, paths


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text):
    parts = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def grow(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def beside(levels, pos):
    out = []
    for level in levels[:-1]:
        run = pos // 3 * 3
        out.append(("".join(level[run:pos]), "".join(level[pos + 1:run + 3])))
        pos //= 3
    return out


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    grown = {s: grow([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    top = grow([grown[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for pos, (_, _, digest, r) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            steps = beside(grown[s], pos) + beside(top, at)
            even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            new = leaf(r, r.text and r.text.replace("\n", "")) if even else digest
            for x, y in steps:
                new = sha(x + new + y)
            out.append((str(r.doc_id), digest, grown[s][-1][0], top[-1][0], sha("".join(x + y for x, y in steps)),
                        new, new == top[-1][0]))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


@pytest.mark.parametrize("depth", [7, 1, 2])  # small blocks: several layers
def test_against_whole_tree(docs, depth):
    want = brute(docs.collect())
    assert got(newline_tampering(docs, depth)) == want
    assert {v for *_, v in want} == {True, False}


def test_one_source_and_one_row(docs):
    one = docs.where("source is null")
    assert got(newline_tampering(one)) == brute(one.collect())
    row = docs.where("doc_id = 3")
    assert got(newline_tampering(row)) == brute(row.collect())


def test_empty(empty):
    assert newline_tampering(empty).count() == 0


def test_versions_share_nodes():
    leaves = [sha(str(i)) for i in range(200)]
    t = PersistentTree(leaves, 5)
    before, size = list(t.digest), len(t.digest)
    v = t.version(t.root, 100, sha("new"))
    assert len(t.digest) - size == 6 and t.digest[:size] == before
    shared = {n for n, _ in t.path(v, 100)} & {n for n, _ in t.path(t.root, 100)}
    assert not shared and t.path(v, 3)[1:] == t.path(t.root, 3)[1:]
    changed = leaves[:100] + [sha("new")] + leaves[101:]
    assert t.digest[v] == grow(changed)[-1][0] == fold(sha("new"), t.siblings(t.root, 100))
    w = t.version(v, 7, sha("other"))  # a version of a version
    changed[7] = sha("other")
    assert t.digest[w] == grow(changed)[-1][0] and t.digest[v] != t.digest[w] and t.digest[t.root] == grow(leaves)[-1][0]


def test_a_tree_over_many_blocks(spark):
    n = 2 * FAN ** DEPTH + 5
    nodes = spark.range(n).selectExpr("'t' as tree", "id as pos", f"{n}L as n", "unhex(sha2(cast(id as string), 256)) as digest")
    levels = grow([sha(str(i)) for i in range(n)])
    for r in paths(nodes).where("pos % 97 = 0 or pos > 4370").collect():
        assert list(zip(r.left, r.right)) == beside(levels, r.pos)
        assert r.top.hex() == levels[-1][0] == fold(sha(str(r.pos)), zip(r.left, r.right))
    assert H("a", "b") == sha("ab")
