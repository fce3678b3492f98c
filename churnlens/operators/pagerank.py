"""PageRank as an iterated join + aggregate over the edge table.

Each round joins the current ranks to the weighted edge table on ``src`` and
sums the contributions per ``dst`` (a partial+final aggregate, so a vertex
with many in-edges is pre-summed map-side). The weighted edge table is
computed once and cached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from churnlens.operators.dense import DenseGraph
from churnlens.operators.iterate import StateLoop, persist
from churnlens.operators.skew import PART, copies, deal, heavy_keys


def _weighted(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(src, dst, od, part_) hash-partitioned by source and part, cached, and
    the heavy sources. Every round joins the rank state on (src, part_), so
    only the state moves, and the edges of a hub lie in many partitions."""
    od = known.groupBy("src").agg(F.count(F.lit(1)).alias("od"))
    heavy = heavy_keys(od, "src", "od")
    n = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = (deal(known, heavy, "src", "dst").join(copies(od, heavy, "src"), ["src", PART])
         .select("src", "dst", "od", PART).repartition(n, "src", PART))
    return persist(w), heavy


def _contrib(w: DataFrame, heavy: DataFrame, ranks: DataFrame) -> DataFrame:
    r = copies(ranks.select(F.col("id").alias("src"), F.col("rank")), heavy, "src")
    return (w.join(r, ["src", PART])
            .groupBy("dst").agg(F.sum(F.col("rank") / F.col("od")).alias("s"))
            .withColumnRenamed("dst", "id"))


def _finished(vertex_ids: DataFrame, ranks: DataFrame, default: float, normalise: str) -> DataFrame:
    """(id, pagerank) of every vertex; ``ranks`` holds those that were computed."""
    ranks = (vertex_ids.select("id").distinct().join(ranks, "id", "left")
             .select("id", F.coalesce("rank", F.lit(default)).alias("rank")))
    if normalise == "n":
        total = ranks.select(F.sum("rank")).scalar()
        n = ranks.select(F.count(F.lit(1)).cast("double")).scalar()
        ranks = ranks.select("id", (F.col("rank") * n / total).alias("rank"))
    elif normalise != "none":
        raise ValueError("normalise must be 'n' or 'none'")
    return ranks.withColumnRenamed("rank", "pagerank")


def pagerank(vertex_ids: DataFrame, e: DataFrame, max_iter: int = 10,
             reset: float = 0.15, tol: float | None = None,
             normalise: str = "n", graph: DenseGraph | None = None) -> DataFrame:
    """GraphX-style PageRank: start 1.0, ``rank = reset + (1-reset)*sum``.

    ``vertex_ids``: one column ``id``. Edges with a null end are ignored.
    Runs ``max_iter`` rounds, or fewer if ``tol`` is given and no rank moved
    by more than ``tol``. ``normalise="n"`` rescales ranks to sum to the
    vertex count (as GraphX does when there are sink vertices); ``"none"``
    keeps raw ranks. ``graph`` is the dense form of ``e``, where it is known.
    Returns (id, pagerank).
    """
    g = graph or DenseGraph.of(e)
    w, heavy = _weighted(g.edges)
    # Sparse state: only vertices with in-edges get a computed rank; every
    # other vertex has rank ``reset`` after the first round (1.0 before), so
    # it is filled in by a left join from the edges instead of being carried.
    ranks = None
    loop = StateLoop()
    for i in range(max_iter):
        default = 1.0 if i == 0 else reset
        if ranks is None:
            r = w.select("src", "dst", "od", F.lit(default).alias("rank"))
        else:
            r = (w.join(copies(ranks.select(F.col("id").alias("src"), "rank"), heavy, "src"), ["src", PART], "left")
                 .select("src", "dst", "od", F.coalesce("rank", F.lit(default)).alias("rank")))
        new = (r.groupBy("dst").agg(F.sum(F.col("rank") / F.col("od")).alias("s"))
               .select(F.col("dst").alias("id"),
                       (F.lit(reset) + F.lit(1.0 - reset) * F.col("s")).alias("rank")))
        old, ranks = ranks, loop.advance(new)
        if tol is not None and old is not None:
            # measured on the stored states, so a round is computed once
            delta = (ranks.alias("n").join(old.alias("o"), "id", "full")
                     .agg(F.max(F.abs(F.coalesce("n.rank", F.lit(reset))
                                      - F.coalesce("o.rank", F.lit(default))))).first()[0])
            if delta is not None and delta < tol:
                break
    w.unpersist(blocking=False)
    if ranks is None:
        return _finished(vertex_ids, vertex_ids.select("id", F.lit(1.0).alias("rank")).limit(0), 1.0, normalise)
    return _finished(vertex_ids, g.back(ranks, "id"), reset, normalise)


#: Rounds of messages that are summed into the ranks at a time.
_SUMMED = 8


def pagerank_active(vertex_ids: DataFrame, e: DataFrame, tol: float = 0.01, reset: float = 0.15,
                    normalise: str = "n", graph: DenseGraph | None = None, sent: list[int] | None = None) -> DataFrame:
    """PageRank to a tolerance per vertex (GraphX's dynamic form): (id, pagerank).

    A vertex holds the residual that it received in the last round. Only where
    that is above ``tol`` does it pass it on, split over its out-edges and times
    ``1 - reset``; its rank is ``reset`` and all it received. Rounds end when no
    vertex is above. So a round reads the edges of the active vertices alone, and
    a region that has settled costs nothing while another still moves.
    ``sent`` takes the number of active vertices of each round.
    """
    g = graph or DenseGraph.of(e)
    w, heavy = _weighted(g.edges)
    loop, total, held = StateLoop(), None, []
    active = g.vertices.select("id", F.lit(reset).alias("delta")).where(F.col("delta") > tol)
    sent = [] if sent is None else sent
    while True:
        n = active.count()
        if n == 0:
            break
        sent.append(n)
        r = copies(active.select(F.col("id").alias("src"), "delta"), heavy, "src")
        got = loop.advance(w.join(r, ["src", PART]).groupBy("dst").agg(
            (F.sum(F.col("delta") / F.col("od")) * F.lit(1.0 - reset)).alias("delta")).select(F.col("dst").alias("id"), "delta"))
        held.append(got)
        active = got.where(F.col("delta") > tol)
        if len(held) == _SUMMED:
            total, held = loop.advance(_summed(held)), []
            held.append(total)
    w.unpersist(blocking=False)
    if not held:
        return _finished(vertex_ids, vertex_ids.select("id", F.lit(reset).alias("rank")).limit(0), reset, normalise)
    ranks = loop.finish(_summed(held).select("id", (F.lit(reset) + F.col("delta")).alias("rank")))
    return _finished(vertex_ids, g.back(ranks, "id"), reset, normalise)


def _summed(deltas: list[DataFrame]) -> DataFrame:
    whole = deltas[0]
    for d in deltas[1:]:
        whole = whole.union(d)
    return whole.groupBy("id").agg(F.sum("delta").alias("delta"))


def pagerank_normalised(e: DataFrame, alpha: float = 0.85, max_iter: int = 20,
                        tol: float | None = None, graph: DenseGraph | None = None) -> DataFrame:
    """NetworkX-style PageRank over the graph of known-end edges.

    Vertices are the edge ends; ranks start at 1/n and sum to 1; the rank of
    sink vertices (no out-edges) is shared evenly by all vertices each round:
    ``x' = alpha*(sum_in x/outdeg + sink/n) + (1-alpha)/n``. Runs ``max_iter``
    rounds, or stops when the L1 change is below ``n * tol``.

    A round is one job: the mass of the sinks and the change are observed
    while the round's ranks are written.
    """
    g = graph or DenseGraph.of(e)
    w, heavy = _weighted(g.edges)
    has_out = w.select(F.col("src").alias("id"), F.lit(False).alias("sink")).distinct()
    n = F.lit(float(g.n))
    sinks = Observation()
    start = g.vertices.join(has_out, "id", "left").select("id", F.coalesce("sink", F.lit(True)).alias("sink"), (F.lit(1.0) / n).alias("rank"))
    loop = StateLoop()
    mass = F.sum(F.when(F.col("sink"), F.col("rank"))).alias("mass")
    ranks = loop.advance(start.observe(sinks, mass))
    for _ in range(max_iter):
        sink_mass = F.lit(float(sinks.get["mass"] or 0.0))
        sinks = Observation()
        new = (ranks.join(_contrib(w, heavy, ranks), "id", "left")
               .select("id", "sink", (F.lit(alpha) * (F.coalesce("s", F.lit(0.0)) + sink_mass / n) + F.lit(1.0 - alpha) / n).alias("rank"),
                       F.col("rank").alias("before"))
               .observe(sinks, mass, F.sum(F.abs(F.col("rank") - F.col("before"))).alias("change")).drop("before"))
        ranks = loop.advance(new)
        if tol is not None and (sinks.get["change"] or 0.0) < tol * g.n:
            break
    w.unpersist(blocking=False)
    return g.back(ranks.select("id", F.col("rank").alias("pagerank")), "id")
