"""Near duplicates among vectors: spherical k-means cells, blocked cosine products.

1. Vectors equal in all components are one class with a count of rows, so a
   vector that a third of all rows repeat is one row from there on.
2. Centroids are fitted on a bounded sample; every class is placed in its nearest
   cell (its home) and probes further cells in the order of nearness. A cell is
   not probed where the plane between both centroids lies farther from the vector
   than linked vectors can lie apart: no link can cross it.
3. A cell's home vectors are cut into blocks of bounded bytes. A task holds one
   block and lets the cell's later blocks and its probing vectors pass in strips;
   a matrix product gives a strip's cosines in double precision. Links are
   counted there, and only links that join components leave the task, never pairs.
   A pair that meets in both vectors' homes counts in one of them.
4. Components are joined; the smallest id of each represents it.

With at most ``probes`` cells the search is exhaustive. With more it may miss a
pair that lies in cells far down both vectors' lists; what is found has its true
cosine. Vectors of different lengths link with nothing of each other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import written
from churnlens.llm.jaccard_join import join_labels

#: Home vectors that a cell aims at, and the most cells there are (their
#: centroids go to every task: at most 16,384 vectors).
PER_CELL, MAX_CELLS = 4096, 16_384
#: Cells that a vector is compared in, its home included.
PROBES = 8
#: Sampled vectors per cell, and in all, that the centroids are fitted on.
PER_CENTROID, MAX_SAMPLE = 16, 131_072
#: Cells up to which each vector meets every centroid; beyond, those of its
#: nearest BEAM groups of centroids.
FLAT, BEAM = 1024, 16
#: Bytes of a block of home vectors, in double precision.
BLOCK_BYTES = 16 << 20
STRIP = 128


def units(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, divided by their lengths."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _lloyd(x: np.ndarray, k: int, rng, rounds: int = 6) -> np.ndarray:
    """Centroids of spherical k-means; an empty cell starts anew at a vector."""
    c = x[rng.choice(len(x), k, replace=len(x) < k)]
    for _ in range(rounds):
        at = np.concatenate([(x[i:i + 2048] @ c.T).argmax(axis=1) for i in range(0, len(x), 2048)])
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        none = size < 1e-9
        sums[none] = x[rng.choice(len(x), int(none.sum()))]
        size[none] = 1
        c = sums / size[:, None]
    return c


@dataclass
class Cells:
    """Centroids in groups; ``start[g]`` is the first cell of group g."""

    heads: np.ndarray
    centroids: np.ndarray
    start: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, k: int, seed: int = 5) -> Cells:
        rng = np.random.default_rng(seed)
        if k <= FLAT:
            return Cells(np.zeros((1, x.shape[1])), _lloyd(x, k, rng), np.array([0, k]))
        heads = _lloyd(x, int(np.ceil(np.sqrt(k))), rng)
        at = np.concatenate([(x[i:i + 2048] @ heads.T).argmax(axis=1) for i in range(0, len(x), 2048)])
        members = [x[at == g] for g in range(len(heads))]
        share = [max(1, round(k * len(m) / len(x))) for m in members]
        fine = [_lloyd(m if len(m) else heads[g:g + 1], n, rng) for g, (m, n) in enumerate(zip(members, share))]
        return Cells(heads, np.concatenate(fine), np.concatenate([[0], np.cumsum(share)]))

    def probes(self, x: np.ndarray, limit: int, reach: float) -> np.ndarray:
        """The cells of unit vectors, nearest first, -1 where there is none."""
        near = np.full((len(x), limit), -np.inf)
        cell = np.full((len(x), limit), -1, np.int64)
        beam = min(BEAM, len(self.heads))
        order = np.argsort(-(x @ self.heads.T), axis=1, kind="stable")[:, :beam]
        for g in np.unique(order):
            rows = np.flatnonzero((order == g).any(axis=1))
            lo, hi = self.start[g], self.start[g + 1]
            both = np.concatenate([near[rows], x[rows] @ self.centroids[lo:hi].T], axis=1)
            ids = np.concatenate([cell[rows], np.broadcast_to(np.arange(lo, hi), (len(rows), hi - lo))], axis=1)
            best = np.argsort(-both, axis=1, kind="stable")[:, :limit]
            near[rows], cell[rows] = np.take_along_axis(both, best, 1), np.take_along_axis(ids, best, 1)
        apart = np.sqrt(np.maximum(((self.centroids[cell] - self.centroids[cell[:, :1]]) ** 2).sum(axis=2), 1e-30))
        cell[:, 1:][((near[:, :1] - near) / apart)[:, 1:] > reach] = -1
        return cell


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, filled with zeros up to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), width), values.dtype)
    out[np.arange(width) < n[:, None]] = values
    return out


def _placer(cells: Cells | None, width: int, probes: int, reach: float):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vec = part.column("vec")
                raw = matrix(vec, width)
                found = np.zeros((len(raw), 1), np.int64) if cells is None else cells.probes(units(raw), probes, reach)
                n = pc.list_value_length(vec).to_numpy(zero_copy_only=False)
                yield pa.record_batch([part.column("set"), part.column("m"), pa.array(found[:, 0]),
                                       pa.array([[c for c in row if c >= 0] for row in found.tolist()], pa.list_(pa.int64())),
                                       pa.array([r[:k].tobytes() for r, k in zip(raw, n)], pa.binary())],
                                      names=["set", "m", "home", "probes", "raw"])

    return run


class _Block:
    """The home vectors that a task holds, their links and components."""

    def __init__(self, cell: int, rows: list[tuple], dtype, threshold: float):
        self.cell, self.threshold, self.dtype = cell, threshold, dtype
        self.set, self.m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        self.probes = np.full((len(rows), max(len(r[3]) for r in rows)), -1)
        for line, r in zip(self.probes, rows):
            line[:len(r[3])] = r[3]
        raw = [r[4] for r in rows]
        self.dims = np.array([len(x) for x in raw])
        self.comp = np.arange(len(rows))
        self.links = np.zeros(len(rows), np.int64)
        self.out: list[tuple] = []
        self.by_dim = {d: (np.flatnonzero(self.dims == d), self._units(raw, self.dims, d)) for d in np.unique(self.dims)}
        for at in range(0, len(rows), STRIP):
            self._strip(rows[at:at + STRIP], at)

    def _units(self, raw, dims, d):
        return units(np.frombuffer(b"".join(x for x, n in zip(raw, dims) if n == d), self.dtype).reshape(-1, d // self.dtype.itemsize))

    def strip(self, rows: list[tuple]):
        """Links of passing rows (set, m, home, probes, raw) with the block."""
        self._strip(rows, None)

    def _strip(self, rows, own):
        home = np.array([r[2] for r in rows])
        dims = np.array([len(r[4]) for r in rows])
        got = np.zeros(len(rows), np.int64)
        for d in np.unique(dims):
            if d not in self.by_dim:
                continue
            at, block = self.by_dim[d]
            mine = np.flatnonzero(dims == d)
            near = self._units([r[4] for r in rows], dims, d) @ block.T >= self.threshold
            for x, hit in zip(mine, near):
                j = at[hit]
                if own is not None:
                    j = j[j > own + x]
                elif home[x] < self.cell:  # a pair that also meets in the lower of its homes counts there
                    j = j[~(self.probes[j] == home[x]).any(axis=1)]
                if not len(j):
                    continue
                got[x] += self.m[j].sum()
                self.links[j] += rows[x][1]
                met = self.comp[j] if own is None else np.append(self.comp[j], self.comp[own + x])
                least = met.min()
                if (met != least).any():
                    self.comp[np.isin(self.comp, met)] = least
                if own is None:
                    self.out.append((rows[x][0], int(self.set[least]), None))
        if own is not None:
            self.links[own:own + len(rows)] += got
        else:
            self.out += [(r[0], None, int(n)) for r, n in zip(rows, got) if n]

    def rows(self):
        self.out += [(int(s), None, int(n)) for s, n in zip(self.set, self.links) if n]
        joins = np.flatnonzero(self.comp != np.arange(len(self.comp)))
        self.out += [(int(self.set[i]), int(self.set[self.comp[i]]), None) for i in joins]
        out, self.out = self.out, []
        return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], names=["set", "other", "links"])


def _comparer(dtype: str, threshold: float):
    """Rows of a unit (cell, block), those of the block (kind 0) before those
    that pass -> counts of links (set, null, links) and joining links."""
    dtype = np.dtype(dtype)

    def run(batches):
        at, lead, block, wait = None, [], None, []

        def flush():
            nonlocal block, wait, lead
            if block is None and lead:
                block, lead = _Block(at[0], lead, dtype, threshold), []
            if wait:
                block.strip(wait)
                wait = []

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                for cell, unit, kind, *row in zip(*(part.column(c).to_pylist() for c in
                                                    ("cell", "unit", "kind", "set", "m", "home", "probes", "raw"))):
                    if (cell, unit) != at:
                        flush()
                        if block is not None:
                            yield block.rows()
                        at, lead, block = (cell, unit), [], None
                    if kind == 0:
                        lead.append(tuple(row))
                    else:
                        wait.append(tuple(row))
                        if len(wait) >= STRIP:
                            flush()
        flush()
        if block is not None:
            yield block.rows()

    return run


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.exists(vec, lambda x: x != 0) & ~bad, F.lit(False))


def near_vectors(rows: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                 probes: int = PROBES, per_cell: int = PER_CELL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, n_links, component_id and kept of every row.

    Two rows link when the cosine of their vectors is at least ``threshold``.
    ``n_links`` counts the other rows that a row links with; ``component_id`` is
    the smallest id reachable, the own id included; ``kept`` marks rows whose id
    that is. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do rows without id, which have no
    component and are kept. A repeated row is another row with the same vector.
    An empty table gives an empty result; other columns are ignored.
    """
    kind = rows.schema[vec_col].dataType.elementType.simpleString()
    if kind not in ("float", "double"):
        rows, kind = rows.withColumn(vec_col, F.col(vec_col).cast("array<double>")), "double"
    vec = F.col(vec_col)
    key = F.xxhash64(vec).alias("h1"), F.xxhash64(F.lit(7), vec).alias("h2")  # equal vectors: equal 128 bits
    known = rows.select(F.col(id_col).alias("id"), *[F.when(usable(vec) & F.col(id_col).isNotNull(), k).alias(n)
                                                     for k, n in zip(key, ("h1", "h2"))], vec.alias("vec"))
    classes = written(known.where("h1 is not null").groupBy("h1", "h2").agg(
        F.first("vec").alias("vec"), F.min("id").alias("id"), F.count(F.lit(1)).alias("m"))
        .withColumn("set", F.monotonically_increasing_id()), "vector-classes")
    n, width = classes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    k = min(max(1, -(-n // per_cell)), MAX_CELLS)
    cells = None
    if k > 1:
        share = min(1.0, min(PER_CENTROID * k, MAX_SAMPLE) / n)
        sample = classes.where(F.pmod(F.xxhash64("h1"), F.lit(1 << 30)) < int(share * (1 << 30))).select("h1", "vec").orderBy("h1").toArrow()
        cells = Cells.fit(units(matrix(sample.column("vec"), width)), k)
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    placed = written(classes.select("set", "m", "vec").mapInArrow(
        _placer(cells, width, probes, reach), "set long, m long, home long, probes array<long>, raw binary"), "placed-vectors")
    per_block = max(STRIP, block_bytes // (8 * max(1, width)))
    blocks = written(placed.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / per_block).alias("blocks"))
                     .withColumnRenamed("home", "cell"), "cell-blocks")
    of = F.pmod(F.xxhash64("set"), F.col("blocks"))
    met = (placed.withColumn("cell", F.explode("probes")).join(blocks, "cell")
           .withColumn("unit", F.explode(F.sequence(F.lit(0), F.when(F.col("cell") == F.col("home"), of)
                                                    .otherwise(F.col("blocks") - 1)))))
    met = met.select("cell", "unit", F.when((F.col("cell") == F.col("home")) & (F.col("unit") == of), 0).otherwise(1).alias("kind"),
                     "set", "m", "home", "probes", "raw")
    found = written(met.repartition("cell", "unit").sortWithinPartitions("cell", "unit", "kind")
                    .mapInArrow(_comparer("<f4" if kind == "float" else "<f8", threshold), "set long, other long, links long"), "vector-links")
    counts = found.where("links is not null").groupBy("set").agg(F.sum("links").alias("links"))
    joins = found.where("other is not null").select(F.col("set").alias("a"), F.col("other").alias("b"))
    linked = written(joins.select(F.explode(F.array("a", "b")).alias("set")).distinct().select("set", F.col("set").alias("comp")), "linked")
    labels = join_labels(linked, joins)
    members = written(classes.select("set", "id", "h1", "h2", "m").join(labels, "set", "left").join(counts, "set", "left")
                      .where("comp is not null or m > 1")
                      .select("h1", "h2", "id", F.coalesce("comp", "set").alias("comp"),
                              (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links")), "linked-classes")
    least = written(members.groupBy("comp").agg(F.min("id").alias("component_id")), "representatives")
    answer = written(members.join(least, "comp").select("h1", "h2", "n_links", "component_id"), "answers")
    out = known.select("id", "h1", "h2").join(answer, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


SQL = """WITH RECURSIVE usable AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id"""
