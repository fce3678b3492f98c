"""Graph queries and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens.operators import degrees
from churnlens.plans.queries import r4, r11, register, rounded, rounded_fine
from churnlens.sources import fixtures as fx
from churnlens.sources.fixtures import with_views

# ---------------------------------------------------------------- degrees

_DEG_SQL = """
  SELECT id, count(*) AS degree,
         CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree
  FROM (SELECT src AS id, 0 AS i, 1 AS o FROM edges
        UNION ALL SELECT dst AS id, 1 AS i, 0 AS o FROM edges) t
  WHERE id IS NOT NULL GROUP BY id"""

_DEG_FEATURES_SQL = """
SELECT s.customer_id, coalesce(d.degree, 0) AS degree,
       coalesce(d.in_degree, 0) AS in_degree, coalesce(d.out_degree, 0) AS out_degree
FROM subscribers s LEFT JOIN deg d ON d.id = s.customer_id"""


def _deg_sql(select: str) -> str:
    return with_views(select, ["edges"], [("deg", _DEG_SQL)])


@register("degree_features", _deg_sql(_DEG_FEATURES_SQL))
def q_degree_features(spark, sf_dir):
    return degrees.degree_features(fx.subscribers(spark, sf_dir), fx.edges(spark, sf_dir))


@register("degree_ratios", _deg_sql(f"""
SELECT customer_id, degree, in_degree, out_degree,
  {r4("CASE WHEN degree = 0 THEN 0.0 ELSE CAST(in_degree AS DOUBLE) / degree END")} AS in_degree_ratio,
  {r4("CASE WHEN degree = 0 THEN 0.0 ELSE CAST(out_degree AS DOUBLE) / degree END")} AS out_degree_ratio
FROM ({_DEG_FEATURES_SQL}) f"""))
def q_degree_ratios(spark, sf_dir):
    f = degrees.degree_features(fx.subscribers(spark, sf_dir), fx.edges(spark, sf_dir))
    return rounded(degrees.with_degree_ratios(f))


@register("top_degree", _deg_sql("""
SELECT id, degree FROM deg ORDER BY degree DESC, id LIMIT 10"""))
def q_top_degree(spark, sf_dir):
    """Top 10 vertices by degree, ties by id (the display at 01:314)."""
    d = degrees.degree_counts(fx.edges(spark, sf_dir))
    return d.select("id", "degree").orderBy(F.desc("degree"), "id").limit(10)


@register("call_edges", with_views("SELECT dst, src FROM edges", ["edges"]))
def q_call_edges(spark, sf_dir):
    return fx.edges(spark, sf_dir)


# ---------------------------------------------------------------- shared

from churnlens.operators import community, labels, neighbours, pagerank, triangles  # noqa: E402
from churnlens.operators.display import edge_display, node_display  # noqa: E402
from churnlens.plans import graph_features as gf  # noqa: E402
from churnlens.plans import oracle_graph as og  # noqa: E402
from churnlens.sources import ingest  # noqa: E402

PAGERANK_ROUNDS = 10
NX_PAGERANK_ROUNDS = 20
LP_ROUNDS_EXPLORE = 5
LP_ROUNDS_FEATURES = 25

_SILV = ("SILV", "SELECT * REPLACE (TRY_CAST(total_charges AS DOUBLE) AS total_charges) FROM subscribers")
_V = ("V", "SELECT customer_id AS id FROM subscribers")


def _vertex_ids(spark, sf_dir):
    return fx.subscribers(spark, sf_dir).select(F.col("customer_id").alias("id"))


def _vertex_attrs(spark, sf_dir):
    return ingest.vertices(ingest.silver_customers(fx.subscribers(spark, sf_dir)))


def _gsql(select: str, ctes: list, bucket: bool = False) -> str:
    views = ["edges", "bucket_edges"] if bucket else ["edges"]
    return with_views(select, ["subscribers"] + views, ctes)


# ---------------------------------------------------------------- one-pass


@register("triangle_count", _gsql(
    "SELECT v.id AS customer_id, CAST(coalesce(t.triangles, 0) AS BIGINT) AS trian_count "
    "FROM V v LEFT JOIN TC t ON t.id = v.id",
    [_V] + og.known() + og.simple_weighted() + og.triangles() + og.triangle_counts()))
def q_triangle_count(spark, sf_dir):
    return triangles.vertex_triangles(fx.subscribers(spark, sf_dir), fx.edges(spark, sf_dir))


@register("clustering_coefficient", _gsql(f"""
SELECT d.customer_id, d.degree, d.trian_count,
  {r4("CASE WHEN d.trian_count = 0 OR d.degree = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(d.trian_count AS DOUBLE) / (CAST(d.degree AS DOUBLE) * (CAST(d.degree AS DOUBLE) - 1) / 2) END")} AS cc
FROM (SELECT v.id AS customer_id, coalesce(g.degree, 0) AS degree,
             CAST(coalesce(t.triangles, 0) AS BIGINT) AS trian_count
      FROM V v LEFT JOIN DEG g ON g.id = v.id LEFT JOIN TC t ON t.id = v.id) d""",
    [_V] + og.degrees() + og.known() + og.simple_weighted() + og.triangles() + og.triangle_counts()))
def q_clustering_coefficient(spark, sf_dir):
    from churnlens.functions.columns import clustering_coefficient
    e = fx.edges(spark, sf_dir)
    s = fx.subscribers(spark, sf_dir)
    d = degrees.degree_features(s, e).select("customer_id", "degree")
    t = triangles.vertex_triangles(s, e)
    j = d.join(t, "customer_id")
    return rounded(j.withColumn("cc", clustering_coefficient("trian_count", "degree")))


@register("clustering_directed", _gsql(
    f"SELECT id, {r4('clustering')} AS clustering FROM DC",
    og.known() + og.simple_weighted() + og.triangles() + og.directed_clustering()))
def q_clustering_directed(spark, sf_dir):
    return rounded(triangles.directed_clustering(fx.edges(spark, sf_dir)))


@register("avg_clustering_directed", _gsql(
    f"SELECT {r4('avg(clustering)')} AS avg_clustering FROM DC",
    og.known() + og.simple_weighted() + og.triangles() + og.directed_clustering()))
def q_avg_clustering_directed(spark, sf_dir):
    return rounded(triangles.average_clustering(fx.edges(spark, sf_dir)))


@register("degree_distribution", _gsql(
    f"SELECT max(degree) AS max_degree, min(degree) AS min_degree, {r4('avg(degree)')} AS avg_degree FROM KD",
    og.known() + og.degrees("K", "KD")))
def q_degree_distribution(spark, sf_dir):
    return rounded(triangles.degree_summary(fx.edges(spark, sf_dir)))


@register("degree_centrality", _gsql(
    f"SELECT id, degree, {r11('degree / (SELECT CAST(count(*) - 1 AS DOUBLE) FROM KD)')} AS degree_centrality FROM KD",
    og.known() + og.degrees("K", "KD")))
def q_degree_centrality(spark, sf_dir):
    return rounded_fine(degrees.degree_centrality(fx.edges(spark, sf_dir)), ["degree_centrality"])


_NB_SELECT = ("SELECT id, " + ", ".join(f"{r4(c)} AS {c}" for c in (
    "nghb_avg_monthly_charges", "nghb_avg_total_charges", "nghb_avg_tenure")) + " FROM NB")


@register("neighbour_averages", _gsql(_NB_SELECT, [_SILV] + og.neighbour_avgs()))
def q_neighbour_averages(spark, sf_dir):
    return rounded(neighbours.neighbour_averages(_vertex_attrs(spark, sf_dir), fx.edges(spark, sf_dir)))


@register("neighbour_averages_out", _gsql(_NB_SELECT, [_SILV] + og.neighbour_avgs(direction="out")))
def q_neighbour_averages_out(spark, sf_dir):
    """Out-neighbours only: the values the reference's notebook produces."""
    return rounded(neighbours.neighbour_averages(_vertex_attrs(spark, sf_dir), fx.edges(spark, sf_dir),
                                                 direction="out"))


# ---------------------------------------------------------------- iterated


@register("pagerank", _gsql(f"SELECT id, {r4('pagerank')} AS pagerank FROM PR",
                            [_V] + og.known() + og.pagerank_graphx(PAGERANK_ROUNDS)))
def q_pagerank(spark, sf_dir):
    return rounded(pagerank.pagerank(_vertex_ids(spark, sf_dir), fx.edges(spark, sf_dir),
                                     max_iter=PAGERANK_ROUNDS))


@register("pagerank_normalised", _gsql(f"SELECT id, {r11('pagerank')} AS pagerank FROM NP",
                                       og.known() + og.pagerank_nx(NX_PAGERANK_ROUNDS)))
def q_pagerank_normalised(spark, sf_dir):
    return rounded_fine(pagerank.pagerank_normalised(fx.edges(spark, sf_dir), max_iter=NX_PAGERANK_ROUNDS), ["pagerank"])


@register("label_propagation", _gsql("SELECT id, label FROM LP",
                                     [_V] + og.known("bucket_edges") + og.label_propagation(LP_ROUNDS_EXPLORE),
                                     bucket=True))
def q_label_propagation(spark, sf_dir):
    return labels.label_propagation(_vertex_ids(spark, sf_dir), fx.bucket_edges(spark, sf_dir),
                                    max_iter=LP_ROUNDS_EXPLORE)


@register("connected_components", _gsql("SELECT id, component FROM CC",
                                        [_V] + og.known("bucket_edges") + og.components(), bucket=True))
def q_connected_components(spark, sf_dir):
    return labels.connected_components(_vertex_ids(spark, sf_dir), fx.bucket_edges(spark, sf_dir))


@register("component_sizes", _gsql(
    "SELECT count(*) AS n_components, max(size) AS largest_component FROM "
    "(SELECT component, count(*) AS size FROM CC GROUP BY component) s",
    og.known("bucket_edges") + [("NV", "SELECT src AS id FROM K UNION SELECT dst FROM K")]
    + og.components("NV"), bucket=True))
def q_component_sizes(spark, sf_dir):
    e = fx.bucket_edges(spark, sf_dir)
    nodes = e.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return community.component_sizes(labels.connected_components(nodes, e))


@register("graph_stats", _gsql(f"""
SELECT (SELECT count(*) FROM NV) AS n_nodes, (SELECT count(*) FROM K) AS n_edges,
  {r4("2 * (SELECT count(*) FROM K) / (SELECT CAST(count(*) AS DOUBLE) FROM NV)")} AS avg_degree,
  {r11("(SELECT count(*) FROM K) / ((SELECT CAST(count(*) AS DOUBLE) FROM NV) * ((SELECT CAST(count(*) AS DOUBLE) FROM NV) - 1))")} AS density,
  (SELECT count(DISTINCT component) FROM CC) = 1 AS is_weakly_connected,
  (SELECT count(DISTINCT component) FROM CC) AS n_components""",
    og.known() + [("NV", "SELECT src AS id FROM K UNION SELECT dst FROM K")] + og.components("NV")))
def q_graph_stats(spark, sf_dir):
    from churnlens.operators.graphstats import graph_stats
    return rounded_fine(graph_stats(fx.edges(spark, sf_dir)), ["density"])


_COMM_COLS = ["comm_avg_monthly_charges", "comm_avg_total_charges", "comm_avg_tenure"]


@register("community_stats", _gsql(
    "SELECT label, " + ", ".join(f"{r4(c)} AS {c}" for c in _COMM_COLS) + ", comm_size FROM CS",
    [_V, _SILV] + og.known("bucket_edges") + og.label_propagation(LP_ROUNDS_FEATURES) + og.community_stats(),
    bucket=True))
def q_community_stats(spark, sf_dir):
    lab = labels.label_propagation(_vertex_ids(spark, sf_dir), fx.bucket_edges(spark, sf_dir),
                                   max_iter=LP_ROUNDS_FEATURES)
    return rounded(community.community_stats(lab, _vertex_attrs(spark, sf_dir)))


@register("community_deviation", _gsql(
    "SELECT l.id, l.label, " + ", ".join(f"{r4('cs.' + c)} AS {c}" for c in _COMM_COLS) + ", cs.comm_size, "
    + ", ".join(f"{r4(f'cs.comm_avg_{a} - a.{a}')} AS comm_dev_avg_{a}"
                for a in ("monthly_charges", "total_charges", "tenure"))
    + " FROM LP l JOIN SILV a ON a.customer_id = l.id LEFT JOIN CS cs ON cs.label = l.label",
    [_V, _SILV] + og.known("bucket_edges") + og.label_propagation(LP_ROUNDS_FEATURES) + og.community_stats(),
    bucket=True))
def q_community_deviation(spark, sf_dir):
    lab = labels.label_propagation(_vertex_ids(spark, sf_dir), fx.bucket_edges(spark, sf_dir),
                                   max_iter=LP_ROUNDS_FEATURES)
    return rounded(community.community_deviation(lab, _vertex_attrs(spark, sf_dir)))


@register("community_sizes", _gsql(
    f"SELECT count(*) AS n_communities, max(size) AS largest_community, {r4('avg(size)')} AS avg_community_size "
    "FROM (SELECT label, count(*) AS size FROM LP GROUP BY label) s",
    [_V] + og.known("bucket_edges") + og.label_propagation(LP_ROUNDS_FEATURES), bucket=True))
def q_community_sizes(spark, sf_dir):
    lab = labels.label_propagation(_vertex_ids(spark, sf_dir), fx.bucket_edges(spark, sf_dir),
                                   max_iter=LP_ROUNDS_FEATURES)
    return rounded(community.community_sizes(lab))


_GF_SQL = f"""
SELECT v.id AS customer_id, coalesce(d.degree, 0) AS degree,
  coalesce(d.in_degree, 0) AS in_degree, coalesce(d.out_degree, 0) AS out_degree,
  {r4("CASE WHEN coalesce(d.degree, 0) = 0 THEN 0.0 ELSE CAST(d.in_degree AS DOUBLE) / d.degree END")} AS in_degree_ratio,
  {r4("CASE WHEN coalesce(d.degree, 0) = 0 THEN 0.0 ELSE CAST(d.out_degree AS DOUBLE) / d.degree END")} AS out_degree_ratio,
  {r4("coalesce(p.pagerank, 0)")} AS pagerank,
  CAST(coalesce(t.triangles, 0) AS BIGINT) AS trian_count,
  {r4("CASE WHEN coalesce(t.triangles, 0) = 0 OR coalesce(d.degree, 0) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(t.triangles AS DOUBLE) / (CAST(d.degree AS DOUBLE) * (CAST(d.degree AS DOUBLE) - 1) / 2) END")} AS cc,
  {r4("coalesce(cs.comm_avg_monthly_charges, 0)")} AS comm_avg_monthly_charges,
  {r4("coalesce(cs.comm_avg_total_charges, 0)")} AS comm_avg_total_charges,
  {r4("coalesce(cs.comm_avg_tenure, 0)")} AS comm_avg_tenure,
  coalesce(cs.comm_size, 0) AS comm_size,
  {r4("coalesce(cs.comm_avg_monthly_charges - a.monthly_charges, 0)")} AS comm_dev_avg_monthly_charges,
  {r4("coalesce(cs.comm_avg_total_charges - a.total_charges, 0)")} AS comm_dev_avg_total_charges,
  {r4("coalesce(cs.comm_avg_tenure - a.tenure, 0)")} AS comm_dev_avg_tenure,
  {r4("coalesce(nb.nghb_avg_monthly_charges, 0)")} AS nghb_avg_monthly_charges,
  {r4("coalesce(nb.nghb_avg_total_charges, 0)")} AS nghb_avg_total_charges,
  {r4("coalesce(nb.nghb_avg_tenure, 0)")} AS nghb_avg_tenure
FROM V v JOIN SILV a ON a.customer_id = v.id
LEFT JOIN DEG d ON d.id = v.id
LEFT JOIN PR p ON p.id = v.id
LEFT JOIN TC t ON t.id = v.id
LEFT JOIN LP l ON l.id = v.id
LEFT JOIN CS cs ON cs.label = l.label
LEFT JOIN NB nb ON nb.id = v.id"""

_GF_CTES = ([_V, _SILV] + og.degrees() + og.known() + og.pagerank_graphx(PAGERANK_ROUNDS)
            + og.simple_weighted() + og.triangles() + og.triangle_counts()
            + og.label_propagation(LP_ROUNDS_FEATURES) + og.community_stats() + og.neighbour_avgs())


@register("graph_features", _gsql(_GF_SQL, _GF_CTES))
def q_graph_features(spark, sf_dir):
    customers = ingest.silver_customers(fx.subscribers(spark, sf_dir))
    return rounded(gf.graph_features(customers, fx.edges(spark, sf_dir),
                                     pagerank_iter=PAGERANK_ROUNDS, label_iter=LP_ROUNDS_FEATURES))


_NX_CTES = og.known() + og.degrees("K", "KD") + og.pagerank_nx(NX_PAGERANK_ROUNDS)
_DC_SQL = "SELECT id, degree / (SELECT CAST(count(*) - 1 AS DOUBLE) FROM KD) AS dc FROM KD"


@register("customer_value", _gsql(
    f"SELECT d.id, {r11('(d.dc + p.pagerank) / 2')} AS customer_value FROM DCT d JOIN NP p ON p.id = d.id",
    _NX_CTES + [("DCT", _DC_SQL)]))
def q_customer_value(spark, sf_dir):
    from churnlens.operators.centrality import customer_value
    return rounded_fine(customer_value(fx.edges(spark, sf_dir), NX_PAGERANK_ROUNDS), ["customer_value"])


@register("top_centrality", _gsql(f"""
SELECT metric, rnk, id, {r11('value')} AS value FROM (
  SELECT 'pagerank' AS metric, id, pagerank AS value,
         row_number() OVER (ORDER BY pagerank DESC, id) AS rnk FROM NP
  UNION ALL
  SELECT 'degree_centrality', id, dc, row_number() OVER (ORDER BY dc DESC, id) FROM DCT) t
WHERE rnk <= 5""", _NX_CTES + [("DCT", _DC_SQL)]))
def q_top_centrality(spark, sf_dir):
    from churnlens.operators.centrality import top_centrality
    return rounded_fine(top_centrality(fx.edges(spark, sf_dir), k=5, pagerank_iter=NX_PAGERANK_ROUNDS), ["value"])


@register("node_display", _gsql(f"""
SELECT s.id, {r11('s.dc')} AS size_metric, {r11('c.pagerank')} AS color_metric,
  {r4("10 + 40 * (s.dc - m.smin) / m.srange")} AS size,
  {r4("(c.pagerank - m.cmin) / m.crange")} AS color_value,
  ['#440154', '#31688E', '#35B779', '#FDE725'][CAST(floor((c.pagerank - m.cmin) / m.crange * 3) AS INT) + 1] AS color,
  s.dc >= m.threshold AS show_label
FROM DCT s JOIN NP c ON c.id = s.id, (
  SELECT min(d.dc) AS smin, CASE WHEN max(d.dc) = min(d.dc) THEN 1 ELSE max(d.dc) - min(d.dc) END AS srange,
         quantile_cont(d.dc, 0.9) AS threshold,
         (SELECT min(pagerank) FROM NP) AS cmin,
         (SELECT CASE WHEN max(pagerank) = min(pagerank) THEN 1 ELSE max(pagerank) - min(pagerank) END FROM NP) AS crange
  FROM DCT d) m""", _NX_CTES + [("DCT", _DC_SQL)]))
def q_node_display(spark, sf_dir):
    from churnlens.operators.centrality import nx_metrics
    m = nx_metrics(fx.edges(spark, sf_dir), NX_PAGERANK_ROUNDS)
    size = m.select("id", F.col("degree_centrality").alias("size_metric"))
    color = m.select("id", F.col("pagerank").alias("color_metric"))
    return rounded_fine(node_display(size, color, scheme="viridis", label_threshold=0.1), ["size_metric", "color_metric"])


def _display_sql(metric: str, palette: list[str], percentile: float) -> str:
    """Display table of one (id, m) metric as size and colour."""
    return f"""
SELECT s.id, {r11('s.m')} AS size_metric, {r11('s.m')} AS color_metric,
  {r4("10 + 40 * (s.m - x.lo) / x.width")} AS size, {r4("(s.m - x.lo) / x.width")} AS color_value,
  {palette}[CAST(floor((s.m - x.lo) / x.width * 3) AS INT) + 1] AS color, s.m >= x.threshold AS show_label
FROM ({metric}) s, (SELECT min(m) AS lo, CASE WHEN max(m) = min(m) THEN 1 ELSE max(m) - min(m) END AS width,
  quantile_cont(m, {percentile}) AS threshold FROM ({metric}) y) x"""


_VALUE_METRIC = "SELECT d.id, (d.dc + p.pagerank) / 2 AS m FROM DCT d JOIN NP p ON p.id = d.id"


@register("node_display_value", _gsql(
    _display_sql(_VALUE_METRIC, ["#0D0887", "#7E03A8", "#CC4778", "#F89441"], 0.95), _NX_CTES + [("DCT", _DC_SQL)]))
def q_node_display_value(spark, sf_dir):
    """Customer value as size and colour, labels for the top 5 percent."""
    from churnlens.operators.centrality import customer_value
    from churnlens.operators.iterate import StateLoop
    m = StateLoop().finish(customer_value(fx.edges(spark, sf_dir), NX_PAGERANK_ROUNDS))
    out = node_display(m.withColumnRenamed("customer_value", "size_metric"), m.withColumnRenamed("customer_value", "color_metric"),
                       scheme="plasma", label_threshold=0.05)
    return rounded_fine(out, ["size_metric", "color_metric"])


@register("node_display_community", _gsql(
    _display_sql("SELECT id, CAST(label AS DOUBLE) AS m FROM LP", ["#003F5C", "#2E4A7B", "#665191", "#A05195"], 0.85)
    .replace("s.m >= x.threshold", "k.degree >= (SELECT quantile_cont(degree, 0.85) FROM KD)")
    .replace(f"{r11('s.m')} AS size_metric", f"{r11('k.degree')} AS size_metric")
    .replace(r4("10 + 40 * (s.m - x.lo) / x.width"), r4(
        "10 + 40 * (k.degree - (SELECT min(degree) FROM KD)) / (SELECT CAST(CASE WHEN max(degree) = min(degree) THEN 1 "
        "ELSE max(degree) - min(degree) END AS DOUBLE) FROM KD)"))
    .replace(") s, (", ") s JOIN KD k ON k.id = s.id, ("),
    og.known("bucket_edges") + [("V", "SELECT src AS id FROM K UNION SELECT dst FROM K")] + og.degrees("K", "KD")
    + og.label_propagation(LP_ROUNDS_EXPLORE), bucket=True))
def q_node_display_community(spark, sf_dir):
    """Degree as size, community as colour, labels for the top 15 percent."""
    e = fx.bucket_edges(spark, sf_dir)
    ids = paths.graph_nodes(e)
    size = degrees.degree_counts(e).select("id", F.col("degree").cast("double").alias("size_metric"))
    color = labels.label_propagation(ids, e, max_iter=LP_ROUNDS_EXPLORE).select("id", F.col("label").cast("double").alias("color_metric"))
    return rounded_fine(node_display(size, color, scheme="cool", label_threshold=0.15), ["size_metric", "color_metric"])


@register("pagerank_to_tolerance", _gsql(
    f"SELECT id, {r4('pagerank')} AS pagerank FROM PA", [_V] + og.known() + og.pagerank_active()))
def q_pagerank_to_tolerance(spark, sf_dir):
    """PageRank with the reference's stop rule: a vertex passes its residual on
    while that is above 0.01."""
    return rounded(pagerank.pagerank_active(_vertex_ids(spark, sf_dir), fx.edges(spark, sf_dir), tol=0.01))


@register("edge_display", _gsql(
    "SELECT src, dst, CAST(1.0 AS DOUBLE) AS weight, CAST(1.0 AS DOUBLE) AS width FROM K", og.known()))
def q_edge_display(spark, sf_dir):
    return edge_display(fx.known_edges(fx.edges(spark, sf_dir)))


# ---------------------------------------------------------------- paths

from churnlens.operators import paths, reach  # noqa: E402

_NV = ("NV", "SELECT src AS id FROM K UNION SELECT dst FROM K")
_UNDIRECTED_ARCS = "SELECT src AS u, dst AS w FROM K WHERE src <> dst UNION SELECT dst, src FROM K WHERE src <> dst"
_IN_ARCS = "SELECT dst AS u, src AS w FROM K WHERE src <> dst"


def _distance_summary(spark, sf_dir):
    """One-row all-pairs summary of the undirected known-end graph; each
    path query below computes it from the tables itself."""
    return reach.distance_summary(fx.edges(spark, sf_dir))


_DIST_CTES = og.known() + [_NV] + og.bfs(_UNDIRECTED_ARCS)
_DIST_AGG = ("(SELECT count(*) AS n FROM NV) n, (SELECT count(*) AS pairs, coalesce(max(d), 0) AS maxd, "
             "coalesce(sum(d), 0) AS sumd FROM BFS WHERE d > 0) p")


@register("diameter", _gsql(
    f"SELECT CASE WHEN p.pairs = n.n * (n.n - 1) THEN CAST(p.maxd AS INT) END AS diameter FROM {_DIST_AGG}",
    _DIST_CTES))
def q_diameter(spark, sf_dir):
    """Diameter of the undirected graph; null when it is not connected."""
    return spark.createDataFrame([(paths.diameter(fx.edges(spark, sf_dir)),)], "diameter int")


@register("avg_path_length", _gsql(
    f"SELECT CASE WHEN p.pairs = n.n * (n.n - 1) THEN {r4('p.sumd / CAST(n.n * (n.n - 1) AS DOUBLE)')} END "
    f"AS avg_shortest_path FROM {_DIST_AGG}", _DIST_CTES))
def q_avg_path_length(spark, sf_dir):
    """Average shortest path length of the undirected graph, if connected."""
    return rounded(_distance_summary(spark, sf_dir).select("avg_shortest_path"))


@register("distance_summary", _gsql(f"""
SELECT n.n AS n_nodes, p.pairs AS n_pairs, CAST(p.maxd AS INT) AS max_distance, CAST(p.sumd AS BIGINT) AS sum_distance,
  p.pairs = n.n * (n.n - 1) AS is_connected,
  CASE WHEN p.pairs = n.n * (n.n - 1) THEN CAST(p.maxd AS INT) END AS diameter,
  CASE WHEN p.pairs = n.n * (n.n - 1) THEN {r4("p.sumd / CAST(n.n * (n.n - 1) AS DOUBLE)")} END AS avg_shortest_path
FROM (SELECT count(*) AS n FROM NV) n,
     (SELECT count(*) AS pairs, coalesce(max(d), 0) AS maxd, coalesce(sum(d), 0) AS sumd FROM BFS WHERE d > 0) p""",
    og.known() + [_NV] + og.bfs(_UNDIRECTED_ARCS)))
def q_distance_summary(spark, sf_dir):
    """Diameter and average shortest path of the undirected graph (exact,
    all sources), with the reachability counts behind them."""
    return rounded(_distance_summary(spark, sf_dir))


@register("closeness", _gsql(f"""
SELECT s AS id, {r11("CASE WHEN sum(d) > 0 THEN (count(*) - 1) / CAST(sum(d) AS DOUBLE) * ((count(*) - 1) / CAST((SELECT count(*) - 1 FROM NV) AS DOUBLE)) ELSE 0.0 END")} AS closeness
FROM BFS GROUP BY s""", og.known() + [_NV] + og.bfs(_IN_ARCS)))
def q_closeness(spark, sf_dir):
    return rounded_fine(reach.closeness(fx.edges(spark, sf_dir)), ["closeness"])


@register("closeness_sketch")
def q_closeness_sketch(spark, sf_dir):
    """Closeness from a distinct-count sketch per vertex, with its error
    (rows-only: an estimate; measured against the exact form in the tests)."""
    return reach.sketch_closeness(fx.edges(spark, sf_dir))


@register("avg_path_length_sketch")
def q_avg_path_length_sketch(spark, sf_dir):
    """Average path length of the undirected graph from sketches (rows-only)."""
    return reach.sketch_path_length(fx.edges(spark, sf_dir))


@register("betweenness_sampled")
def q_betweenness_sampled(spark, sf_dir):
    """Betweenness from sampled shortest paths with its greatest error
    (rows-only: an estimate; measured against the exact form in the tests)."""
    from churnlens.operators.path_samples import sampled_betweenness
    return sampled_betweenness(fx.edges(spark, sf_dir))


@register("betweenness")
def q_betweenness(spark, sf_dir):
    """Exact normalised betweenness over all sources (rows-only; checked
    against a brute-force count on small graphs in the tests)."""
    return paths.betweenness(fx.edges(spark, sf_dir))


@register("top_betweenness")
def q_top_betweenness(spark, sf_dir):
    """The five bridge customers by betweenness, ties by id (rows-only)."""
    from churnlens.operators.centrality import top_k
    b = paths.betweenness(fx.edges(spark, sf_dir)).withColumnRenamed("betweenness", "value")
    return top_k(b, "betweenness", "value", 5)


# ---------------------------------------------------------------- Louvain

from churnlens.operators import louvain as lv  # noqa: E402


@register("louvain")
def q_louvain(spark, sf_dir):
    """Louvain communities of the undirected bucket graph (rows-only; the
    unit tests check modularity against a brute-force count)."""
    return lv.louvain(fx.bucket_edges(spark, sf_dir))


@register("louvain_modularity")
def q_louvain_modularity(spark, sf_dir):
    """Modularity of the Louvain partition and of the label-propagation
    partition of the same graph (rows-only, one row)."""
    e = fx.bucket_edges(spark, sf_dir)
    comm = lv.louvain(e).withColumnRenamed("community", "label")
    nodes = paths.graph_nodes(e)
    lp = labels.label_propagation(nodes, e, max_iter=LP_ROUNDS_FEATURES)
    q_lv, q_lp = lv.modularity(e, comm), lv.modularity(e, lp)
    n_lv = comm.select(F.count_distinct("label")).first()[0]
    return spark.createDataFrame([(q_lv, n_lv, q_lp)],
                                 "louvain_modularity double, louvain_communities long, "
                                 "label_propagation_modularity double")


@register("community_labels")
def q_community_labels(spark, sf_dir):
    """Communities by semi-synchronous label propagation, the reference's
    fallback (rows-only; the tests compare a sequential form)."""
    from churnlens.operators.colouring import semi_synchronous_labels
    return semi_synchronous_labels(_vertex_ids(spark, sf_dir), fx.bucket_edges(spark, sf_dir))
