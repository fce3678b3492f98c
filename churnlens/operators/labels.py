"""Label propagation (communities) and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.dense import DenseGraph
from churnlens.operators.iterate import StateLoop, persist, stored
from churnlens.operators.skew import PART, copies, deal, heavy_keys


#: Votes are counted for the neighbours of moved vertices alone where at most
#: one in so many vertices moved.
_SPARSE = 16


def _vote_edges(e: DataFrame) -> DataFrame:
    """(to, frm): each known-end, non-loop edge carries a vote both ways."""
    k = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull()
                & (F.col("src") != F.col("dst")))
    return (k.select(F.col("dst").alias("to"), F.col("src").alias("frm"))
            .unionByName(k.select(F.col("src").alias("to"), F.col("dst").alias("frm"))))


def ballots(g: DenseGraph, votes: DataFrame) -> tuple[Column, Column]:
    """An aggregate over (label, n) rows that ranks labels by votes, then the
    smaller first, and the winning label of that aggregate, named ``key``.

    Votes and label are packed into one number, which Spark aggregates by
    hashing; where a vertex has so many votes that they don't fit, a struct is
    ranked instead, by sorting.
    """
    bits = max(1, (g.n - 1).bit_length())
    most = votes.groupBy("to").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    last = F.lit((1 << bits) - 1)
    if most.bit_length() + bits < 63:
        return (F.max(F.shiftleft("n", bits) + last - F.col("label")).alias("key"), last - F.col("key").bitwiseAND(last))
    return F.max(F.struct("n", (last - F.col("label")).alias("l"))).alias("key"), last - F.col("key.l")


def label_rounds(g: DenseGraph, max_iter: int, recomputed: list[int] | None = None) -> DataFrame:
    """(id, label) of the vertices with neighbours after ``max_iter`` rounds.

    A vertex whose neighbours have the labels of two rounds ago takes the label
    that it had a round ago. So only the neighbours of vertices that moved, by
    this comparison, need a count of votes; and when none moved, the labels stand
    or alternate, and those of the last round are known. ``recomputed`` takes how
    many vertices each round counted votes for.
    """
    votes_edges = _vote_edges(g.edges)
    n_parts = int(g.edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best, winner = ballots(g, votes_edges)
    heavy = heavy_keys(votes_edges.groupBy("frm").agg(F.count(F.lit(1)).alias("n")), "frm")
    # sorted as the merge join of a round needs it, so no round sorts the edges
    votes_edges = persist(deal(votes_edges, heavy, "frm", "to").repartition(n_parts, "frm", PART).sortWithinPartitions("frm", PART))
    state = votes_edges.select(F.col("to").alias("id")).distinct().select(
        "id", F.col("id").alias("label"), F.lit(None).cast("long").alias("before"), F.lit(True).alias("moved"))
    loop, n, moved = StateLoop(), None, None

    def sent_to(ids: DataFrame) -> DataFrame:
        """The votes that the vertices ``ids`` send."""
        return votes_edges.join(copies(ids.select(F.col("id").alias("frm")), heavy, "frm"), ["frm", PART])

    for i in range(max_iter):
        if moved == 0:
            last = "label" if (max_iter - i) % 2 == 0 else "before"
            state = state.select("id", F.col(last).alias("label"))
            break
        labels = state.select(F.col("id").alias("frm"), "label")
        sparse = moved is not None and moved * _SPARSE <= n
        if not sparse:
            votes = votes_edges.join(copies(labels, heavy, "frm"), ["frm", PART])
        else:  # every vote goes both ways: what a vertex receives is where it sends to
            near = stored(sent_to(state.where("moved")).select(F.col("to").alias("id")).distinct())
            votes = sent_to(near).select(F.col("frm").alias("to"), F.col("to").alias("frm")).join(labels, "frm")
        won = (votes.groupBy("to", "label").agg(F.count(F.lit(1)).alias("n"))
               .groupBy(F.col("to").alias("id")).agg(best).select("id", winner.alias("won")))
        new = F.coalesce("won", "before")
        state = loop.advance(state.join(won, "id", "left").select(
            "id", new.alias("label"), F.col("label").alias("before"), (~new.eqNullSafe(F.col("before"))).alias("moved")))
        seen = state.agg(F.count(F.lit(1)), F.count_if("moved")).first()
        if recomputed is not None:
            recomputed.append(near.count() if sparse else seen[0])
        n, moved = seen
    labels = state.select("id", "label") if max_iter else stored(state.select("id", "label"))
    votes_edges.unpersist(blocking=False)
    return labels


def label_propagation(vertex_ids: DataFrame, e: DataFrame, max_iter: int = 5, graph: DenseGraph | None = None) -> DataFrame:
    """Synchronous label propagation for ``max_iter`` rounds; (id, label).

    Every vertex starts with its own id. Each round every vertex takes the
    label most frequent among its neighbours' labels (one vote per directed
    edge, both directions; a reciprocal pair votes twice, a self-loop not at
    all); ties go to the smallest label; a vertex without neighbours keeps its
    label. Votes are counted per (vertex, label) with a partial aggregate and
    the winner is the largest packed number of votes and label, so a hub's
    votes are reduced map-side and never collected as a list.

    The loop state holds only vertices with neighbours (they receive votes
    every round), as dense ids; all other vertices keep their id and are added
    once at the end. Rounds that would change nothing, or only take turns, are
    known without being counted (``label_rounds``). The vote edges are hash-partitioned by sender (a heavy one
    by parts) once and cached, so a round moves only the label state and the
    counted votes. ``graph`` is the dense form of ``e``, where it is known.
    """
    g = graph or DenseGraph.of(e)
    labels = g.back(label_rounds(g, max_iter), "id", "label")
    return (vertex_ids.select("id").distinct().join(labels, "id", "left")
            .select("id", F.coalesce("label", "id").alias("label")))


def _undirected_pairs(e: DataFrame) -> DataFrame:
    k = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull()
                & (F.col("src") != F.col("dst")))
    return k.select(F.greatest("src", "dst").alias("big"),
                    F.least("src", "dst").alias("small")).distinct()


def _both_ways(p: DataFrame) -> DataFrame:
    return (p.select(F.col("big").alias("u"), F.col("small").alias("v"))
            .unionByName(p.select(F.col("small").alias("u"), F.col("big").alias("v"))))


def component_rounds(pairs: DataFrame) -> DataFrame:
    """(big, small) stars of the components of (big, small) pairs.

    A round first stores each vertex's least neighbour and number of
    neighbours. Where every vertex with several neighbours is smaller than all
    of them, the pairs are stars and the rounds end. The table of one row per
    vertex is stored and not aggregated in place, so AQE can split a hub's part
    of the joins with it.
    """
    p = stored(pairs)
    while True:
        near = stored(_both_ways(p).groupBy("u").agg(F.min("v").alias("mv"), F.count(F.lit(1)).alias("n")))
        if near.where("n > 1 and mv < u").isEmpty():
            return p
        # large star: every larger neighbour of u to the minimum of u's closed neighbourhood
        large = stored(_both_ways(p).join(near.select("u", "mv"), "u").where(F.col("v") > F.col("u"))
                       .select(F.col("v").alias("big"), F.least("mv", "u").alias("small")).distinct())
        # small star: u and its smaller neighbours to the minimum of them
        least = stored(large.groupBy("big").agg(F.min("small").alias("m")))
        p = stored(large.join(least, "big").select(F.col("small").alias("big"), F.col("m").alias("small"))
                   .unionByName(least.select("big", F.col("m").alias("small")))
                   .where(F.col("big") != F.col("small")).distinct())


def connected_components(vertex_ids: DataFrame, e: DataFrame, graph: DenseGraph | None = None) -> DataFrame:
    """Weakly connected components; (id, component), component = smallest id.

    Alternating large-star / small-star rounds (Kiveris et al., 2014) over
    the undirected pair set of dense ids; each round is a few joins and
    aggregates over at most the current pairs, and the number of rounds grows
    with log^2 of the vertex count rather than with the graph diameter. On exit
    every vertex points at its component's smallest id; vertices without edges
    are their own component.
    """
    g = graph or DenseGraph.of(e)
    p = component_rounds(_undirected_pairs(g.edges))
    found = g.back(p.select(F.col("big").alias("id"), F.col("small").alias("component")), "id", "component")
    return (vertex_ids.select("id").distinct().join(found, "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))
