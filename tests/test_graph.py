"""Graph operators on hand-made and small random graphs vs brute force."""

import random

import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from churnlens.operators import (community, degrees, labels, neighbours, pagerank,
                                 path_samples, paths, reach, searches, triangles)

# triangle a-b-c (b->a reciprocated), tail c->d, self-loop e, off-network
# ends (null), a separate path f->g->h, and isolated z (vertex only).
HAND = [("a", "b"), ("b", "c"), ("c", "a"), ("b", "a"), ("c", "d"), ("e", "e"),
        (None, "a"), ("b", None), ("f", "g"), ("g", "h")]
HAND_VERTICES = list("abcdefghz")


def random_graph(seed, n=12, m=30):
    rnd = random.Random(seed)
    ids = [f"v{i:02d}" for i in range(n)]
    edges = {(rnd.choice(ids), rnd.choice(ids)) for _ in range(m)}
    return ids, sorted(edges)


GRAPHS = [(HAND_VERTICES, HAND)] + [random_graph(s) for s in (1, 2, 3)]


def _map(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_degrees(spark, edge_frame, vs, es):
    e = edge_frame(es)
    v = spark.createDataFrame([(x,) for x in vs], "customer_id string")
    got = {r["customer_id"]: (r["degree"], r["in_degree"], r["out_degree"])
           for r in degrees.degree_features(v, e).collect()}
    deg, ind, outd = bf.degrees(es)
    assert got == {x: (deg[x], ind[x], outd[x]) for x in vs}
    # property: in-degree total equals out-degree total over all edges
    c = degrees.degree_counts(e).agg(F.sum("in_degree"), F.sum("out_degree")).first()
    assert c[0] == sum(1 for _, d in set(es) if d is not None)
    assert c[1] == sum(1 for s, _ in set(es) if s is not None)


def test_self_loop_counts_twice(edge_frame):
    d = {r["id"]: r["degree"] for r in degrees.degree_counts(edge_frame(HAND)).collect()}
    assert d["e"] == 2


def test_ratio_zero_degree(spark):
    df = spark.createDataFrame([(0, 0, 0), (4, 1, 3)], "degree long, in_degree long, out_degree long")
    rows = degrees.with_degree_ratios(df).orderBy("degree").collect()
    assert rows[0]["in_degree_ratio"] == 0.0 and rows[1]["out_degree_ratio"] == 0.75


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_triangles(spark, edge_frame, vs, es):
    e = edge_frame(es)
    got = _map(triangles.triangle_counts(e), "id", "triangles")
    want = {k: v for k, v in bf.triangles(es).items() if v}
    assert got == want
    assert sum(got.values()) % 3 == 0


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_directed_clustering(spark, edge_frame, vs, es):
    got = _map(triangles.directed_clustering(edge_frame(es)), "id", "clustering")
    want = bf.directed_clustering(es)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_pagerank_graphx(spark, edge_frame, id_frame, vs, es):
    got = _map(pagerank.pagerank(id_frame(vs), edge_frame(es), max_iter=7), "id", "pagerank")
    want = bf.pagerank_graphx(vs, es, 7)
    for k in vs:
        assert got[k] == pytest.approx(want[k], rel=1e-9)
    assert sum(got.values()) == pytest.approx(len(vs))


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_pagerank_nx(spark, edge_frame, vs, es):
    got = _map(pagerank.pagerank_normalised(edge_frame(es), max_iter=9), "id", "pagerank")
    want = bf.pagerank_nx(es, 9)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9)
    assert sum(got.values()) == pytest.approx(1.0)


def _sequential_active(vs, es, tol):
    """Residual PageRank one round and vertex at a time; (ranks, active vertices by round)."""
    out = {}
    for s, d in bf.known(es):
        out.setdefault(s, []).append(d)
    rank, active, sizes = {v: 0.15 for v in vs}, {v: 0.15 for v in vs if 0.15 > tol}, []
    ends = {x for p in bf.known(es) for x in p}
    active = {v: d for v, d in active.items() if v in ends}
    while active:
        sizes.append(len(active))
        got = {}
        for v, d in active.items():
            for w in out.get(v, []):
                got[w] = got.get(w, 0) + d / len(out[v])
        for w in got:
            got[w] *= 0.85
            rank[w] += got[w]
        active = {w: d for w, d in got.items() if d > tol}
    return rank, sizes


@pytest.mark.parametrize("vs,es", GRAPHS)
@pytest.mark.parametrize("tol", [0.2, 0.05, 0.001])
def test_pagerank_by_active_vertices(spark, edge_frame, id_frame, vs, es, tol):
    sent = []
    got = _map(pagerank.pagerank_active(id_frame(vs), edge_frame(es), tol, normalise="none", sent=sent), "id", "pagerank")
    want, sizes = _sequential_active(vs, es, tol)
    assert set(got) == set(vs) and sent == sizes
    for k in vs:
        assert got[k] == pytest.approx(want[k], rel=1e-9)


def test_active_vertices_grow_fewer(spark, edge_frame, id_frame):
    vs, es = random_graph(7, 60, 240)
    sent = []
    a = _map(pagerank.pagerank_active(id_frame(vs), edge_frame(es), 1e-3, sent=sent), "id", "pagerank")
    b = _map(pagerank.pagerank(id_frame(vs), edge_frame(es), max_iter=60), "id", "pagerank")
    assert sent[0] > sent[-1] and len(sent) > 9  # more rounds than are summed at a time
    assert all(a[k] == pytest.approx(b[k], abs=0.1) for k in vs)
    assert sum(a.values()) == pytest.approx(len(vs))


def test_dense_ids_keep_the_order(spark):
    from churnlens.operators.dense import DenseGraph, dictionary
    ids = [f"{i * 37 % 2000}" for i in range(3000)] + [None, "é", ""]
    got = dictionary(spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)).collect()
    want = sorted({i for i in ids if i is not None}, key=lambda s: s.encode())
    assert [r.id for r in sorted(got, key=lambda r: r.k)] == want and sorted(r.k for r in got) == list(range(len(want)))
    e = spark.createDataFrame(HAND, "src string, dst string").select("dst", "src")
    g = DenseGraph.of(e)
    assert sorted((r.src, r.dst) for r in g.back(g.edges, "src", "dst").collect()) == sorted(bf.known(HAND))
    assert DenseGraph.of(e.limit(0)).n == 0


def test_rounds_hash_aggregate(spark, edge_frame):
    from churnlens.operators.dense import DenseGraph
    g = DenseGraph.of(edge_frame(HAND))
    votes = labels._vote_edges(g.edges)
    best, winner = labels.ballots(g, votes)
    msgs = votes.join(g.vertices.select(F.col("id").alias("frm"), F.col("id").alias("label")), "frm").groupBy("to", "label").agg(
        F.count(F.lit(1)).alias("n"))
    near = labels._both_ways(labels._undirected_pairs(g.edges)).groupBy("u").agg(F.min("v"), F.count(F.lit(1)))
    for df in (msgs.groupBy("to").agg(best).select("to", winner.alias("label")), near):
        assert "SortAggregate" not in df._jdf.queryExecution().toString()


def test_ballots_beyond_one_number(spark):
    from churnlens.operators.dense import DenseGraph
    g = DenseGraph(None, None, 1 << 62)  # so many vertices that votes and label don't fit in 63 bits
    votes = spark.createDataFrame([(0, 5), (0, 6)], "to long, frm long")
    best, winner = labels.ballots(g, votes)
    rows = spark.createDataFrame([(0, 9, 2), (0, 7, 3), (0, 8, 3)], "to long, label long, n long")
    assert rows.groupBy("to").agg(best).select(winner.alias("w")).first().w == 7


@pytest.mark.parametrize("vs,es", GRAPHS)
@pytest.mark.parametrize("rounds", [1, 3, 6])
def test_label_propagation(spark, edge_frame, id_frame, vs, es, rounds):
    got = _map(labels.label_propagation(id_frame(vs), edge_frame(es), max_iter=rounds), "id", "label")
    assert got == bf.label_propagation(vs, es, rounds)


@pytest.mark.parametrize("es,rounds,counted", [
    ([("a", "b")], 25, [2, 2]),  # labels take turns for ever
    ([("a", "b")], 24, [2, 2]),
    ([("h", f"l{i}") for i in range(9)] + [("x", "y"), ("y", "z"), ("z", "x")], 25, None),
    # most settle soon, the end of a long path moves on: late rounds count its surroundings alone
    ([(f"t{i}{x}", f"t{i}{y}") for i in range(60) for x, y in ("ab", "bc", "ca")] + [(f"p{i:02}", f"p{i + 1:02}") for i in range(24)], 17, None),
    ([(f"p{i:02}", f"p{i + 1:02}") for i in range(24)], 40, None)])
def test_label_rounds_end_when_labels_stand_or_alternate(spark, edge_frame, es, rounds, counted):
    from churnlens.operators.dense import DenseGraph
    vs, recomputed = sorted({v for e in es for v in e}), []
    g = DenseGraph.of(edge_frame(es))
    got = _map(g.back(labels.label_rounds(g, rounds, recomputed), "id", "label"), "id", "label")
    assert got == bf.label_propagation(vs, es, rounds)
    if counted is not None:
        assert recomputed == counted
    if len(vs) > 100:
        assert recomputed[0] == len(vs) and 0 < min(recomputed) <= 25


@pytest.mark.parametrize("vs,es", GRAPHS + [(
    [f"{i}" for i in range(30)], [(f"{i}", f"{i + 1}") for i in range(29)])])
def test_components(spark, edge_frame, id_frame, vs, es):
    got = _map(labels.connected_components(id_frame(vs), edge_frame(es)), "id", "component")
    want = bf.components(vs, es)
    assert got == want
    assert all(c <= v for v, c in got.items())


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_closeness(spark, edge_frame, vs, es):
    got = _map(reach.closeness(edge_frame(es), words=1), "id", "closeness")
    want = bf.closeness(es)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_betweenness(spark, edge_frame, vs, es):
    got = _map(paths.betweenness(edge_frame(es), batch_size=4), "id", "betweenness")
    want = bf.betweenness(es)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


@pytest.mark.parametrize("vs,es", GRAPHS)
def test_distance_summary(spark, edge_frame, vs, es):
    got = reach.distance_summary(edge_frame(es), words=1).first().asDict()
    want = bf.distance_summary(es)
    for k, v in want.items():
        assert got[k] == v
    if not want["is_connected"]:
        assert got["diameter"] is None and got["avg_shortest_path"] is None


@pytest.fixture(scope="module")
def wide(spark):
    """A graph of over 64 vertices: several words and passes of source bits."""
    vs, es = random_graph(11, 150, 400)
    return es, spark.createDataFrame(es, "src string, dst string").select("dst", "src")


def test_distances_of_several_passes(wide):
    es, e = wide
    got, want = _map(reach.closeness(e, words=1), "id", "closeness"), bf.closeness(es)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    row = reach.distance_summary(e, words=2).first().asDict()
    assert all(row[k] == v for k, v in bf.distance_summary(es).items())


@pytest.mark.parametrize("lg_k", [5, 11])
def test_sketches_stay_near_the_exact_values(wide, lg_k):
    es, e = wide
    row, want = reach.sketch_path_length(e, lg_k).first(), bf.distance_summary(es)
    exact = want["sum_distance"] / want["n_pairs"]
    assert row.rel_std_error == pytest.approx(reach.sketch_error(lg_k))
    assert abs(row.avg_shortest_path / exact - 1) < 3 * row.rel_std_error and row.hops >= want["max_distance"] - 1
    got, near = _map(reach.sketch_closeness(e, lg_k), "id", "closeness"), bf.closeness(es)
    off = [abs(got[k] / near[k] - 1) for k in near if near[k]]
    assert set(got) == set(near) and sum(off) / len(off) < 3 * reach.sketch_error(lg_k)
    assert all(got[k] == 0 for k in near if not near[k])


def test_sampled_betweenness_keeps_its_bound(wide):
    es, e = wide
    rows = path_samples.sampled_betweenness(e, eps=0.06).collect()
    want = bf.betweenness(es)
    assert {r.id for r in rows} == set(want)
    assert max(abs(r.betweenness - want[r.id]) for r in rows) < rows[0].max_error
    top = max(want, key=want.get)
    assert top in sorted((r.id for r in rows), key=lambda i: -next(r.betweenness for r in rows if r.id == i))[:5]


def test_sampled_paths_in_small_batches(spark, edge_frame):
    es = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "x"), ("x", "c"), ("e", "e"), ("d", "a")]
    a = _map(path_samples.sampled_betweenness(edge_frame(es), eps=0.12, rows=1), "id", "betweenness")
    want = bf.betweenness(es)
    assert all(abs(a[k] - want[k]) < 0.12 * 5 / 3 + 0.02 for k in want) and a["e"] == 0
    assert {r.betweenness for r in path_samples.sampled_betweenness(edge_frame([("a", "b")])).collect()} == {0.0}


def test_sample_size():
    assert path_samples.sample_size(0.05, 0.1, 10) == -(-200 * (3 + 1 + 2.302585092994046) // 1)
    assert path_samples.sample_size(0.05, 0.1, 2) == 1


def test_neighbour_directions(spark, edge_frame):
    v = spark.createDataFrame([("a", 1.0, 10.0, 1), ("b", 2.0, None, 2), ("c", 4.0, 40.0, 4)],
                              "id string, monthly_charges double, total_charges double, tenure int")
    e = edge_frame([("a", "b"), ("a", "c"), ("c", "a")])
    both = _map(neighbours.neighbour_averages(v, e, "both"), "id", "nghb_avg_monthly_charges")
    out = _map(neighbours.neighbour_averages(v, e, "out"), "id", "nghb_avg_monthly_charges")
    assert both["a"] == pytest.approx((2 + 4 + 4) / 3) and out["a"] == pytest.approx(3.0)
    assert both["b"] == 1.0 and "b" not in out
    tot = _map(neighbours.neighbour_averages(v, e, "out"), "id", "nghb_avg_total_charges")
    assert tot["a"] == 40.0  # null total of b ignored


def test_community_deviation(spark):
    lab = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "id string, label string")
    v = spark.createDataFrame([("a", 1.0, 10.0, 1), ("b", 3.0, None, 3), ("c", 5.0, 50.0, 5)],
                              "id string, monthly_charges double, total_charges double, tenure int")
    rows = {r["id"]: r for r in community.community_deviation(lab, v).collect()}
    assert rows["a"]["comm_size"] == 2 and rows["a"]["comm_avg_monthly_charges"] == 2.0
    assert rows["a"]["comm_dev_avg_monthly_charges"] == 1.0
    assert rows["b"]["comm_dev_avg_total_charges"] is None
    assert rows["a"]["comm_avg_total_charges"] == 10.0


def _brute_modularity(es, lab):
    pairs = {tuple(sorted(p)) for p in bf.known(es)}
    m = len(pairs)
    deg = {}
    for a, b in pairs:
        deg[a] = deg.get(a, 0) + (2 if a == b else 1)
        if a != b:
            deg[b] = deg.get(b, 0) + 1
    inside = sum(1 for a, b in pairs if lab[a] == lab[b])
    tot = {}
    for v, k in deg.items():
        tot[lab[v]] = tot.get(lab[v], 0) + k
    return inside / m - sum(t * t for t in tot.values()) / (4 * m * m)


def test_louvain_two_cliques(spark, edge_frame):
    from churnlens.operators.louvain import louvain, modularity
    a = [f"a{i}" for i in range(5)]
    b = [f"b{i}" for i in range(5)]
    es = [(x, y) for g in (a, b) for x in g for y in g if x < y] + [("a0", "b0")]
    e = edge_frame(es)
    lab = _map(louvain(e), "id", "community")
    assert {lab[x] for x in a} == {"a0"} and {lab[x] for x in b} == {"b0"}
    q = modularity(e, spark.createDataFrame(list(lab.items()), "id string, label string"))
    assert q == pytest.approx(_brute_modularity(es, lab), abs=1e-12)


@pytest.mark.parametrize("vs,es", GRAPHS[1:])
def test_louvain_beats_singletons(spark, edge_frame, vs, es):
    from churnlens.operators.louvain import louvain, modularity
    e = edge_frame(es)
    lab = _map(louvain(e), "id", "community")
    q = modularity(e, spark.createDataFrame(list(lab.items()), "id string, label string"))
    singletons = {x: x for x in lab}
    assert q == pytest.approx(_brute_modularity(es, lab), abs=1e-12)
    assert q >= _brute_modularity(es, singletons) - 1e-12


@pytest.mark.parametrize("resolution", [1.0, 0.5])
def test_louvain_keeps_its_modularity_from_the_moves(spark, edge_frame, resolution):
    """Planted groups, a hub tied to half of all vertices, loops and edges given
    both ways: every round raises the modularity, which at the end is that of
    the whole partition."""
    import random
    from churnlens.operators.louvain import louvain, modularity
    rnd = random.Random(5)
    ids = [f"v{i:02d}" for i in range(48)]
    es = [(a, ids[(i // 12) * 12 + rnd.randrange(12)]) for i, a in enumerate(ids) for _ in range(4)]
    es += [(b, a) for a, b in es[::3]] + [("hub", a) for a in ids[::2]] + [("v01", "v01"), ("alone", "alone")]
    e = edge_frame(es)
    trace = []
    lab = _map(louvain(e, resolution, trace), "id", "community")
    assert trace == sorted(set(trace)) and set(lab) == {*ids, "hub", "alone"}
    assert lab["alone"] == "alone"
    for c in set(lab.values()):
        assert c == min(v for v in lab if lab[v] == c)
    q = modularity(e, spark.createDataFrame(list(lab.items()), "id string, label string"), resolution)
    assert trace[-1] == pytest.approx(q, abs=1e-9)
    if resolution == 1.0:
        assert q == pytest.approx(_brute_modularity(es, lab), abs=1e-9)
        planted = {v: str((i // 12)) for i, v in enumerate(ids)} | {"hub": "0", "alone": "alone"}
        assert q >= _brute_modularity(es, planted) - 0.02


def test_louvain_of_no_edges(spark, edge_frame):
    from churnlens.operators.louvain import louvain
    none = spark.createDataFrame([("a", None)], "dst string, src string")
    assert louvain(none).count() == 0


def _sequential_labels(vs, es):
    """Greedy colours in the order of priority, then labels one vertex at a time."""
    import hashlib
    near = {v: set() for v in {x for p in bf.known(es) for x in p}}
    for a, b in bf.known(es):
        near[a].add(b)
        near[b].add(a)
    colour = {}
    for v in sorted(near, key=lambda x: hashlib.md5(x.encode()).hexdigest() + x):
        used = {colour[w] for w in near[v] if w != v and w in colour}
        colour[v] = next(c for c in range(len(near) + 1) if c not in used)
    label, moved = {v: v for v in near}, True
    while moved:
        moved = False
        for v in sorted(near, key=lambda x: colour[x]):
            votes = {}
            for w in near[v]:
                votes[label[w]] = votes.get(label[w], 0) + 1
            best = [x for x, n in votes.items() if n == max(votes.values())]
            if label[v] not in best:
                label[v], moved = max(best), True
    return colour, {v: label.get(v, v) for v in vs}


@pytest.mark.parametrize("vs,es", [GRAPHS[0], random_graph(5, 40, 70)])
def test_labels_by_colours(spark, edge_frame, id_frame, vs, es):
    from churnlens.operators.colouring import colouring, neighbours_of, semi_synchronous_labels
    from churnlens.operators.dense import DenseGraph
    colour, label = _sequential_labels(vs, es)
    g, rounds, changes = DenseGraph.of(edge_frame(es)), [], []
    found = colouring(g, rounds)
    assert _map(g.back(found, "id"), "id", "colour") == colour and sum(rounds) == len(colour)
    ends = neighbours_of(g).join(found.withColumnRenamed("id", "u"), "u").join(
        found.select(F.col("id").alias("v"), F.col("colour").alias("other")), "v")
    assert ends.where("colour = other").isEmpty()
    assert _map(semi_synchronous_labels(id_frame(vs), edge_frame(es), g, changes), "id", "label") == label
    assert changes[-1] == 0


def test_sketches_keep_two_states_on_disk(spark, edge_frame):
    import os
    from churnlens.operators.dense import DenseGraph
    from churnlens.operators.reach import sketch_reach
    from churnlens.session import scratch_path
    g = DenseGraph.of(edge_frame([(f"{i:02d}", f"{i + 1:02d}") for i in range(9)]))
    at = scratch_path(spark, "state").removeprefix("file:")
    before = set(os.listdir(at))
    reach, hops = sketch_reach(g, "undirected")
    assert hops == 9 and len(set(os.listdir(at)) - before) == 3  # the arcs and two states, not one a hop
    assert {r.id: (r.reached, r.far) for r in reach.collect()} == {
        k: (10, sum(abs(k - x) for x in range(10))) for k in range(10)}


def _jobs(spark, run):
    """How many jobs ``run`` needs."""
    seen = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    run()
    return len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - seen)


def _odd_graph():
    """A long path, a hub of over 64 callers, copies, loops and unknown ends."""
    path = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(90)]
    hub = [(f"h{i:03d}", "p040") for i in range(100)] + [("p010", f"h{i:03d}") for i in range(0, 100, 7)]
    return path + path[:5] + hub + [("p003", "p003"), ("l", "l"), (None, "p001"), ("p002", None)]


@pytest.mark.parametrize("arcs,es", [(0, HAND), (1 << 25, HAND), (1 << 25, [("l", "l")]), (1 << 25, [(None, "a")])])
def test_searches_in_tasks_and_by_rounds(edge_frame, monkeypatch, arcs, es):
    monkeypatch.setattr(searches, "ARCS", arcs)
    e = edge_frame(es)
    assert _map(reach.closeness(e, words=1), "id", "closeness") == pytest.approx(bf.closeness(es))
    row = reach.distance_summary(e, words=1).first().asDict()
    assert {k: row[k] for k in ("n_nodes", "n_pairs", "max_distance", "sum_distance")} == {
        k: bf.distance_summary(es)[k] for k in ("n_nodes", "n_pairs", "max_distance", "sum_distance")}
    assert _map(paths.betweenness(e), "id", "betweenness") == pytest.approx(bf.betweenness(es))
    want = bf.distance_summary(es)
    assert paths.diameter(e, sources=2) == (want["max_distance"] if want["n_nodes"] and want["is_connected"] else None)


def test_closeness_jobs_do_not_grow_with_hops_and_sources(spark, edge_frame):
    es, got = _odd_graph(), {}
    jobs = _jobs(spark, lambda: got.update(_map(reach.closeness(edge_frame(es), words=1), "id", "closeness")))
    assert got == pytest.approx(bf.closeness(es), rel=1e-12)
    assert jobs < 60, jobs


def test_distance_summary_jobs_do_not_grow_with_hops_and_sources(spark, edge_frame):
    es, got = _odd_graph(), {}
    jobs = _jobs(spark, lambda: got.update(reach.distance_summary(edge_frame(es), words=2).first().asDict()))
    assert all(got[k] == v for k, v in bf.distance_summary(es).items())
    assert jobs < 60, jobs


def test_betweenness_jobs_do_not_grow_with_hops_and_sources(spark, edge_frame):
    es, got = _odd_graph(), {}
    jobs = _jobs(spark, lambda: got.update(_map(paths.betweenness(edge_frame(es), batch_size=50), "id", "betweenness")))
    assert got == pytest.approx(bf.betweenness(es), rel=1e-9, abs=1e-15)
    assert jobs < 60, jobs


def test_diameter_jobs_do_not_grow_with_hops(spark, edge_frame):
    es, got = [(s, d) for s, d in _odd_graph() if s != "l"][:125], []
    jobs = _jobs(spark, lambda: got.append(paths.diameter(edge_frame(es), sources=70)))
    assert got == [bf.distance_summary(es)["max_distance"]] == [90]
    assert jobs < 60, jobs
