import numpy as np
import pytest

from churnlens.llm.near_vectors import Cells, near_vectors, units


def brute(rows, threshold=0.95):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    ok = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    up, links = {k: k for k, _ in rows}, [0] * len(rows)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for dim in {len(rows[i][1]) for i in ok}:
        mine = [i for i in ok if len(rows[i][1]) == dim]
        u = units(np.array([rows[i][1] for i in mine]))
        for a, b in zip(*np.nonzero(np.triu(u @ u.T >= threshold, 1))):
            x, y = mine[a], mine[b]
            links[x] += 1
            links[y] += 1
            p, q = find(rows[x][0]), find(rows[y][0])
            up[max(p, q)] = min(p, q)
    return sorted((str(k), n, str(None if k is None else find(k)), k is None or find(k) == k) for (k, _), n in zip(rows, links))


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(1, k, v, 7) for k, v in rows], f"set int, vec_id long, embedding array<{kind}>, m int").repartition(4)


def got(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def planted(n, dim, seed=1, near=0.3):
    """Random vectors; a share of them are copies or noisy copies of others."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for i in range(n // 2, n):
        j = rng.integers(0, n // 20)
        x[i] = x[j] + rng.standard_normal(dim) * rng.choice([0, 0.05, 0.2, near])
    return [(int(k), v.astype(np.float32).tolist()) for k, v in zip(rng.permutation(n), x)]


ODD = [(9000, None), (9001, []), (9002, [0.0] * 8), (9003, [1.0, None] + [0.0] * 6), (9004, [float("nan")] + [1.0] * 7),
       (9005, [float("inf")] * 8), (9006, [1.0] * 8), (9007, [2.0] * 8), (9008, [1.0] * 7), (9009, [3.0] * 7), (None, [1.0] * 8),
       (9010, [1e30] * 8), (9011, [1e-30] * 8), (9012, [0.0] * 7 + [-0.0]), (9006, [1.0] * 8), (9013, [-1.0] * 8)]


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("per_cell, block_bytes", [(4096, 16 << 20), (40, 16 << 20), (100, 1 << 10)])
def test_all_pairs(spark, kind, per_cell, block_bytes):
    rows = planted(600, 8) + ODD
    # as many probes as cells: nothing may be missed
    assert got(near_vectors(frame(spark, rows, kind), probes=20, per_cell=per_cell, block_bytes=block_bytes)) == brute(rows)


def test_recall(spark):
    rows = planted(6000, 64, near=0.22)
    found = {r[0]: r[1] for r in got(near_vectors(frame(spark, rows), per_cell=60))}  # 100 cells, 8 probed
    want = {r[0]: r[1] for r in brute(rows)}
    assert all(found[k] <= want[k] for k in want)
    assert sum(found.values()) >= 0.97 * sum(want.values()) > 0


def test_a_third_are_copies_and_a_third_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    x = np.concatenate([np.tile(base, (700, 1)), base + rng.standard_normal((700, 16)) * 0.1, rng.standard_normal((700, 16))])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    assert got(near_vectors(frame(spark, rows), per_cell=100, probes=30, block_bytes=1 << 14)) == brute(rows)


def test_groups_of_centroids():
    rng = np.random.default_rng(3)
    x = units(rng.standard_normal((6000, 16)))
    cells = Cells.fit(x, 1500)
    assert len(cells.heads) > 1 and cells.start[-1] == len(cells.centroids)
    found = cells.probes(x[:300], 8, 2.0)
    true = np.argsort(-(x[:300] @ cells.centroids.T), axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(found, true)]) > 0.9
    assert np.all((x[:300, None] * cells.centroids[found]).sum(2)[:, 0] >= (x[:300, None] * cells.centroids[found]).sum(2)[:, -1])


def test_cut_cells_hold_no_links():
    rng = np.random.default_rng(4)
    x = units(rng.standard_normal((400, 4)))
    cells, reach = Cells.fit(x, 40), np.sqrt(0.1)
    y = units(x + rng.standard_normal(x.shape) * 0.05)
    home, probed = cells.probes(y, 40, reach)[:, 0], cells.probes(x, 40, reach)
    assert (probed == -1).any()
    for a, b, h, p in zip(x, y, home, probed):
        assert a @ b < 0.95 or h in p


def test_empty(spark):
    assert near_vectors(frame(spark, ODD).where("false")).count() == 0
    assert got(near_vectors(frame(spark, ODD[:3]))) == brute(ODD[:3])
