"""Triangle listing and the clustering coefficients built on it.

Triangles are listed once each on the simple undirected graph (loops and
duplicate or reciprocal edges collapsed). Every undirected edge is oriented
from the lower to the higher (degree, id) end; in that order each triangle
a < b < c is the path a->b->c closed by a->c, found by one equi-join on the
middle vertex and one on the (a, c) pair. A vertex keeps at most sqrt(2m)
out-edges under this orientation, so the middle-vertex join emits at most
O(m^1.5) paths in total, and a hub (high degree, hence few out-edges) is
never asked to pair up its own neighbours. Edges and degrees are stored
tables, so both sides of every join are shuffled for it and AQE splits a hub's
part: in the degree lookups of the orientation, and in the middle-vertex join,
whose left side holds the hub's many in-edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.degrees import degree_counts
from churnlens.operators.iterate import stored


def weighted_simple_edges(e: DataFrame) -> DataFrame:
    """Undirected edges (u < v) of known-end, non-loop edges, with
    ``w`` = number of directed edges between the two (1 or 2)."""
    known = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull()
                    & (F.col("src") != F.col("dst")))
    return (known.select(F.least("src", "dst").alias("u"),
                         F.greatest("src", "dst").alias("v"))
            .groupBy("u", "v").agg(F.count(F.lit(1)).alias("w")))


def oriented_edges(simple: DataFrame) -> DataFrame:
    """Orient each undirected edge low -> high by (undirected degree, id)."""
    ends = simple.select(F.inline(F.array(F.struct(F.col("u").alias("x")),
                                          F.struct(F.col("v").alias("x")))))
    deg = stored(ends.groupBy("x").agg(F.count(F.lit(1)).alias("d")))
    j = (simple.join(deg.select(F.col("x").alias("u"), F.col("d").alias("du")), "u")
         .join(deg.select(F.col("x").alias("v"), F.col("d").alias("dv")), "v"))
    u_first = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    return j.select(F.when(u_first, F.col("u")).otherwise(F.col("v")).alias("a"),
                    F.when(u_first, F.col("v")).otherwise(F.col("u")).alias("b"),
                    "w")


def list_triangles(e: DataFrame) -> DataFrame:
    """One row per undirected triangle: (a, b, c, w_ab, w_bc, w_ac)."""
    o = stored(oriented_edges(stored(weighted_simple_edges(e))))  # each is read several times
    ab = o.select("a", "b", F.col("w").alias("w_ab"))
    bc = o.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("w").alias("w_bc"))
    ac = o.select("a", F.col("b").alias("c"), F.col("w").alias("w_ac"))
    return ab.join(bc, "b").join(ac, ["a", "c"]).select("a", "b", "c", "w_ab", "w_bc", "w_ac")


def triangle_counts(e: DataFrame) -> DataFrame:
    """(id, triangles) for every vertex in at least one triangle."""
    t = list_triangles(e)
    return (t.select(F.explode(F.array("a", "b", "c")).alias("id"))
            .groupBy("id").agg(F.count(F.lit(1)).alias("triangles")))


def vertex_triangles(vertices: DataFrame, e: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """Triangle count per vertex of ``vertices`` (0 when none)."""
    t = triangle_counts(e).withColumnRenamed("id", id_col)
    return (vertices.select(id_col).join(t, id_col, "left")
            .select(id_col, F.coalesce("triangles", F.lit(0)).cast("bigint").alias("trian_count")))


def directed_clustering(e: DataFrame) -> DataFrame:
    """Clustering of each vertex of the directed graph (Fagiolo's form).

    With s(i,j) the number of directed edges between i and j (loops
    ignored), T(i) = 2 * sum over triangles {i,j,k} of s_ij*s_jk*s_ki,
    d(i) = sum_j s(i,j), r(i) = number of reciprocated neighbours, and
    c(i) = T(i) / (2 * (d(i)*(d(i)-1) - 2*r(i))), 0 when T(i) = 0.
    Vertices are the ends of known-end edges (self-loop-only vertices
    included, with c = 0).
    """
    known = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    nodes = (known.select(F.explode(F.array("src", "dst")).alias("id")).distinct())
    simple = weighted_simple_edges(e)
    ends = simple.select(F.inline(F.array(
        F.struct(F.col("u").alias("id"), F.col("w")),
        F.struct(F.col("v").alias("id"), F.col("w")))))
    dstats = ends.groupBy("id").agg(F.sum("w").alias("dt"),
                                    F.count_if(F.col("w") == 2).alias("db"))
    t = list_triangles(e).withColumn("p", F.col("w_ab") * F.col("w_bc") * F.col("w_ac"))
    tri = (t.select(F.explode(F.array("a", "b", "c")).alias("id"), "p")
           .groupBy("id").agg((F.sum("p") * 2).alias("t")))
    j = nodes.join(dstats, "id", "left").join(tri, "id", "left")
    dt, db, tt = F.coalesce("dt", F.lit(0)), F.coalesce("db", F.lit(0)), F.coalesce("t", F.lit(0))
    denom = (dt * (dt - 1) - db * 2) * 2
    return j.select("id", F.when(tt == 0, F.lit(0.0))
                    .otherwise(tt.cast("double") / denom.cast("double")).alias("clustering"))


def average_clustering(e: DataFrame) -> DataFrame:
    return directed_clustering(e).agg(F.avg("clustering").alias("avg_clustering"))


def degree_summary(e: DataFrame) -> DataFrame:
    """Max, min and mean total degree over vertices of known-end edges."""
    known = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    d = degree_counts(known)
    return d.agg(F.max("degree").alias("max_degree"), F.min("degree").alias("min_degree"),
                 F.avg("degree").alias("avg_degree"))
