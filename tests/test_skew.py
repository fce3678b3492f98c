"""Hot keys: results and row counts by partition with 90 % of the edges on
one vertex."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from churnlens.operators import labels, pagerank, skew, triangles


@pytest.fixture(scope="module")
def star(spark):
    rng = random.Random(1)
    edges = [("hub", f"v{i}") for i in range(2700)] + [(f"v{rng.randrange(2700)}", f"v{rng.randrange(2700)}") for _ in range(300)]
    edges = sorted(set(edges))
    return edges, spark.createDataFrame(edges, "src string, dst string").select("dst", "src")


def largest_share(df):
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(rows) / (sum(rows) / len(rows))


def test_cached_pagerank_edges_are_even(spark, star):
    w, heavy = pagerank._weighted(star[1])
    assert largest_share(w) < 3 and w.count() == len(star[0])
    assert heavy.count() <= 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    w.unpersist()


def test_dealt_join_is_even_and_complete(spark, star):
    counts = star[1].groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    heavy = skew.heavy_keys(counts, "src")
    dealt = skew.deal(star[1], heavy, "src", "dst").repartition(8, "src", skew.PART)
    assert largest_share(dealt) < 3
    joined = dealt.join(skew.copies(counts, heavy, "src"), ["src", skew.PART])
    assert joined.count() == len(star[0])
    want = Counter(s for s, _ in star[0])
    assert all(r.n == want[r.src] for r in joined.collect())


def test_results_with_a_hub(spark, star):
    edges, e = star
    ids = sorted({x for p in edges for x in p})
    v = spark.createDataFrame([(i,) for i in ids], "id string")
    got = {r.id: r.component for r in labels.connected_components(v, e).collect()}
    assert set(got.values()) == {"hub"}
    tri = {r.id: r.triangles for r in triangles.triangle_counts(e).collect()}
    near = {}
    for s, d in edges:
        if s != d:
            near.setdefault(s, set()).add(d)
            near.setdefault(d, set()).add(s)
    want = {i: sum(len(near[i] & near[j]) for j in near[i]) // 2 for i in near}
    assert tri == {i: n for i, n in want.items() if n}
    pr = {r.id: r.pagerank for r in pagerank.pagerank(v, e, max_iter=2, normalise="none").collect()}
    out = Counter(s for s, _ in edges)
    rank = {i: 1.0 for i in ids}
    for _ in range(2):
        s = Counter()
        for a, b in edges:
            s[b] += rank[a] / out[a]
        rank = {i: 0.15 + 0.85 * s[i] for i in ids}
    assert all(pr[i] == pytest.approx(rank[i], rel=1e-9) for i in ids)


def test_tolerance_ends_the_rounds(spark, star):
    edges, e = star
    v = e.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    a = {r.id: r.pagerank for r in pagerank.pagerank(v, e, max_iter=50, tol=1e-6).collect()}
    b = {r.id: r.pagerank for r in pagerank.pagerank(v, e, max_iter=12).collect()}
    assert all(a[i] == pytest.approx(b[i], abs=1e-3) for i in a)




@pytest.mark.parametrize("seed", [1, 2])
def test_diameter_by_bounds(spark, seed):
    from churnlens.operators import paths
    rng = random.Random(seed)
    n = 24
    edges = {(f"v{i:03d}", f"v{max(0, i - 1 - rng.randrange(1 + 3 * seed)):03d}") for i in range(1, n)}
    near = {}
    for s, d in edges:
        near.setdefault(s, set()).add(d)
        near.setdefault(d, set()).add(s)

    def far(s):
        seen, level, d = {s}, {s}, 0
        while level := {y for x in level for y in near[x]} - seen:
            seen |= level
            d += 1
        return d

    e = spark.createDataFrame(sorted(edges), "src string, dst string").select("dst", "src")
    assert paths.diameter(e, sources=4) == max(map(far, near))


def test_diameter_of_other_graphs(spark):
    from churnlens.operators import paths
    make = lambda rows: spark.createDataFrame(rows, "src string, dst string").select("dst", "src")
    assert paths.diameter(make([("a", "b"), ("c", "d")])) is None
    assert paths.diameter(make([(None, "b")])) is None
    assert paths.diameter(make([("a", "a")])) == 0
    assert paths.diameter(make([("a", "b"), ("b", "a")])) == 1


def test_large_tables_of_loops_are_not_broadcast(spark):
    few, many = spark.range(100), spark.range(100)
    for rows, form in ((skew.BROADCAST_ROWS, "BroadcastHashJoin"), (skew.BROADCAST_ROWS + 1, "SortMergeJoin")):
        joined = many.join(skew.sized(few, rows), "id")
        assert joined.count() == 100
        assert form in joined._jdf.queryExecution().executedPlan().toString()


def test_louvain_of_shuffled_states_is_that_of_broadcast_ones(spark, monkeypatch):
    from churnlens.operators import louvain as lv
    rng = random.Random(3)
    ids = [f"v{i:02d}" for i in range(40)]
    es = [(a, ids[i // 10 * 10 + rng.randrange(10)]) for i, a in enumerate(ids) for _ in range(4)] + [("hub", a) for a in ids]
    e = spark.createDataFrame(es + [("v01", "v01")], "src string, dst string").select("dst", "src")
    found, plans, proposals = [], [], lv._proposals

    def seen(*args):
        df = proposals(*args)
        # while the arcs are cached; the plan that made them stands in both
        plans.append([x._jdf.queryExecution().executedPlan().toString() for x in (df, args[0])])
        return df

    monkeypatch.setattr(lv, "_proposals", seen)
    for limit in (skew.BROADCAST_ROWS, 0):
        monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
        trace = []
        found.append(({r.id: r.community for r in lv.louvain(e, 1.0, trace).collect()}, trace))
    assert found[0] == found[1] and len(found[0][1]) > 1
    plan, of_arcs = plans[-1]
    assert "InMemoryTableScan" in plan and plan.count("BroadcastHashJoin") == of_arcs.count("BroadcastHashJoin")


def test_arcs_of_a_hub_are_even(spark, star, monkeypatch):
    from churnlens.operators import louvain as lv
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    arcs = lv.undirected_arcs(star[1]).where("u <> v")
    degrees = lv._node_degrees(arcs).withColumnRenamed("u", "id")
    laid, nodes = lv._laid_out(arcs, degrees, degrees.count())
    assert laid.count() == arcs.count() and nodes.where("parts > 1").first().id == "hub"
    assert largest_share(laid) < 3
    state = nodes.select("id", F.col("id").alias("c"), "k", "parts", F.col("k").alias("tot"))
    met = lv._at_arcs(laid.select("u", "v", "w", skew.PART), state.select(F.col("id").alias("v"), "c", "parts"), 1)
    assert met.count() == arcs.count() and met.where("v <> c").isEmpty()
    laid.unpersist()


def test_labels_by_colours_of_shuffled_states(spark, star, monkeypatch):
    from churnlens.operators.colouring import semi_synchronous_labels
    ids = spark.createDataFrame([("hub",), ("alone",)], "id string").union(spark.range(2700).selectExpr("concat('v', id) AS id"))
    found = []
    for limit in (skew.BROADCAST_ROWS, 0):
        monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
        found.append({r.id: r.label for r in semi_synchronous_labels(ids, star[1]).collect()})
    assert found[0] == found[1] and found[0]["alone"] == "alone"
