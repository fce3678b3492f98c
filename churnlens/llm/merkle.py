"""Merkle manifest of a table, with a persistent tree for tampered leaves.

A row's leaf is the hash of its fields. Per tree (source) leaves ascend by id;
every three consecutive nodes become their hash until one is left, the subroot.
Subroots by source give the root in the same way.

Positions come from a range partitioning with per-partition offsets, so a
source that holds a third of all rows lies in many tasks. A tree is cut into
aligned blocks of seven levels, 2,187 leaves. A first pass gives the
blocks' roots; their tree, smaller by that factor, is built the same way, layer
by layer. A second pass holds one block at a time in a persistent tree: each
tampered leaf makes a version that copies only the leaf's ancestors within the
block and shares all other nodes. Every version then continues through the
layers above: its block root is hashed on with the untouched nodes beside the
path of its block, which the block's rows meet once, as one row.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import CRC_TABLE_SQL, crc32_sql, ranked, written

#: Children of a node.
FAN = 3
#: Levels of a block.
DEPTH = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class PersistentTree:
    """Nodes are appended, never changed. A version is the number of its root;
    versions share all nodes that they have in common."""

    def __init__(self, leaves: list[str], levels: int):
        self.digest, self.kids = list(leaves), [()] * len(leaves)
        self.levels, row = levels, range(len(leaves))
        for _ in range(levels):
            row = [self._node(tuple(row[i:i + FAN])) for i in range(0, len(row), FAN)]
        if len(row) != 1:
            raise ValueError("more leaves than the levels hold")
        self.root = row[0]

    def _node(self, kids: tuple[int, ...]) -> int:
        self.digest.append(H(*[self.digest[k] for k in kids]))
        self.kids.append(kids)
        return len(self.digest) - 1

    def path(self, root: int, pos: int) -> list[tuple[int, int]]:
        """(node, which child is next) from the root down to a leaf's parent."""
        out, node = [], root
        for level in reversed(range(self.levels)):
            turn = pos // FAN ** level % FAN
            out.append((node, turn))
            node = self.kids[node][turn]
        return out

    def siblings(self, root: int, pos: int) -> list[tuple[str, str]]:
        """What stands left and right of the path, from the leaf's level up."""
        out = []
        for node, turn in reversed(self.path(root, pos)):
            side = [self.digest[k] for k in self.kids[node]]
            out.append(("".join(side[:turn]), "".join(side[turn + 1:])))
        return out

    def version(self, root: int, pos: int, digest: str) -> int:
        """The version of ``root`` with another leaf at ``pos``."""
        path = self.path(root, pos)
        self.digest.append(digest)
        self.kids.append(())
        new = len(self.digest) - 1
        for node, turn in reversed(path):
            kids = self.kids[node]
            new = self._node(kids[:turn] + (new,) + kids[turn + 1:])
        return new


def fold(digest: str, steps) -> str:
    for left, right in steps:
        digest = H(left, digest, right)
    return digest


def _levels(n: int, depth: int) -> int:
    """Levels of a tree of ``n`` leaves that lie in one block."""
    levels = 0
    while n > 1 and levels < depth:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _blocks(batches, key: tuple[str, ...]):
    """Rows in order -> lists of the rows (as dicts) of one block."""
    at, held = None, []
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            for row in batch.slice(i, 512).to_pylist():
                k = tuple(row[c] for c in key)
                if k != at:
                    if held:
                        yield held
                    at, held = k, []
                held.append(row)
    if held:
        yield held


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _block(depth: int) -> Column:
    return F.floor(F.col("pos") / FAN ** depth).alias("block")


def _in_blocks(nodes: DataFrame, depth: int) -> DataFrame:
    return (nodes.select("*", _block(depth)).repartition("tree", "block")
            .sortWithinPartitions("tree", "block", "pos"))


_ROOTS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])
_PATHS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("block", pa.int64()),
                    ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])


def _tree(rows: list[dict], depth: int) -> PersistentTree:
    return PersistentTree([r["digest"].hex() for r in rows], _levels(rows[0]["n"], depth))


def block_roots(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Nodes (tree, pos, n, digest), n being the tree's size -> the nodes of
    the layer above."""

    def run(batches):
        for rows in _blocks(batches, ("tree", "block")):
            t, r = _tree(rows, depth), rows[0]
            yield _table([(r["tree"], r["block"], -(-r["n"] // FAN ** depth), bytes.fromhex(t.digest[t.root]))], _ROOTS)

    return _in_blocks(nodes, depth).mapInArrow(run, "tree string, pos long, n long, digest binary")


def _block_paths(nodes: DataFrame, depth: int) -> DataFrame:
    """What stands beside each node's path to the root of its block."""

    def run(batches):
        for rows in _blocks(batches, ("tree", "block")):
            t = _tree(rows, depth)
            out = []
            for i, r in enumerate(rows):
                steps = t.siblings(t.root, i)
                out.append((r["tree"], r["pos"], r["block"], [x for x, _ in steps], [y for _, y in steps]))
            yield _table(out, _PATHS)

    return _in_blocks(nodes, depth).mapInArrow(run, "tree string, pos long, block long, left array<string>, right array<string>")


def paths(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(tree, pos, left, right, top): what stands beside the path from each
    node to its tree's top, and the top. Layer by layer, each smaller by a block's size."""
    largest = nodes.agg(F.max("n")).first()[0]
    if largest is None or largest <= 1:
        none = F.array().cast("array<string>")
        return nodes.select("tree", "pos", none.alias("left"), none.alias("right"), F.col("digest").alias("top"))
    own = _block_paths(nodes, depth)
    above = paths(written(block_roots(nodes, depth), "merkle-layer"), depth).select(
        "tree", F.col("pos").alias("block"), F.col("left").alias("l"), F.col("right").alias("r"), "top")
    return own.join(above, ["tree", "block"]).select(
        "tree", "pos", F.concat("left", "l").alias("left"), F.concat("right", "r").alias("right"), "top")


def _leaf(fields: dict[str, Column]) -> Column:
    """The hash of fields: a dash where null, else UTF-8 byte count, colon, value."""
    parts = []
    for c in fields.values():
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


_OUT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied long"
_OUT_ARROW = pa.schema([(c.split()[0], {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}[c.split()[1]])
                        for c in _OUT.split(", ")])


def _verifier(depth: int):
    """A block's row of kind 0 (the path above it), then its leaves -> their
    proofs and the roots that their versions give."""

    def run(batches):
        for rows in _blocks(batches, ("tree", "block")):
            up, rows = rows[0], rows[1:]
            above = list(zip(up["left"], up["right"]))
            beside = "".join(x + y for x, y in above)
            tree, sub, root = _tree(rows, depth), up["subroot"].hex(), up["root"].hex()
            out = []
            for i, r in enumerate(rows):
                steps = tree.siblings(tree.root, i)
                size = len(tree.digest)
                if r["changed"] is None:
                    top = fold(r["digest"].hex(), steps)
                else:
                    top = tree.digest[tree.version(tree.root, i, r["changed"].hex())]
                folded = fold(top, above)
                out.append((r["doc_id"], r["digest"].hex(), sub, root, H("".join(x + y for x, y in steps), beside),
                            folded, folded == root, len(tree.digest) - size))
            yield _table(out, _OUT_ARROW)

    return run


def manifest(docs: DataFrame, tampered: Column | None = None, changed: dict[str, Column] | None = None,
             fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", tree_col: str = "source", depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every
    row, and ``copied``: the nodes that its version added within its block.

    Rows where ``tampered`` holds have the columns in ``changed`` replaced; a
    row that this leaves as it was makes no version. Null ids come first in
    their tree, null sources form the first tree; rows that repeat an id follow
    the order of their leaves, and identical rows differ in nothing but their
    proofs. An empty table gives an empty result. Columns of ``docs`` that are
    not fields are ignored, whatever their names; texts may be of any length.
    """
    id_type = docs.schema[id_col].dataType
    plain = {c: F.col(c) for c in fields}
    other = _leaf({**plain, **(changed or {})})
    leaves = docs.select(F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("s"), F.col(tree_col).cast("string")), F.lit("")).alias("tree"),
                         _leaf(plain).alias("digest"), F.when(F.lit(False) if tampered is None else tampered, other).alias("changed"))
    leaves = leaves.withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed")))
    placed = ranked(written(leaves, "merkle-leaves"), "tree", ["id", "digest"])
    base = written(block_roots(placed.select("tree", "pos", "n", "digest"), depth), "merkle-blocks")
    up = written(paths(base, depth), "merkle-paths")
    subs = written(up.where("pos = 0").select("tree", F.col("top").alias("digest")), "merkle-subroots")
    placed_subs = written(ranked(subs.withColumn("all", F.lit("")), "all", ["tree"]), "merkle-top")
    tops = paths(placed_subs.select(F.col("all").alias("tree"), "pos", "n", "digest"), depth).join(
        placed_subs.select("pos", F.col("tree").alias("of")), "pos").select(
        F.col("of").alias("tree"), F.col("left").alias("l"), F.col("right").alias("r"), F.col("top").alias("root"))
    heads = up.join(tops, "tree").select(
        "tree", F.col("pos").alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("pos"),
        F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("doc_id"), F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("binary").alias("changed"), F.concat("left", "l").alias("left"), F.concat("right", "r").alias("right"),
        F.col("top").alias("subroot"), "root")
    no, none = F.lit(None).cast("array<string>"), F.lit(None).cast("binary")
    rows = placed.select("tree", _block(depth), F.lit(1).alias("kind"), "pos", "n",
                         F.col("id").cast("string").alias("doc_id"), "digest", "changed", no.alias("left"), no.alias("right"),
                         none.alias("subroot"), none.alias("root"))
    out = (heads.union(rows).repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "pos")
           .mapInArrow(_verifier(depth), _OUT))
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type)).withColumnRenamed("doc_id", id_col)


def newline_tampering(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The manifest of documents; where 2 divides the crc32 of the id, the
    text's newlines are deleted."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(docs, even, {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}, depth=depth)


def _leaf_sql(text: str) -> str:
    field = lambda v: f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')"
    return f"sha256({' || '.join(field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: trees(tree, level, pos, n, h) from rows of level 0
_GROW_SQL = """{name}(tree, level, pos, n, h) AS (SELECT tree, 0, pos, n, h FROM {base}
  UNION ALL SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY tree, level, pos // 3, n)"""
#: what stands left and right of a node in its run
_BESIDE_SQL = """{name} AS (SELECT a.tree, a.level, a.pos, a.h, a.n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
  coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r FROM {trees} a LEFT JOIN {trees} b
  ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3 AND a.pos <> b.pos GROUP BY ALL)"""

SQL = f"""WITH RECURSIVE {CRC_TABLE_SQL},
leaves AS (SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")}
       ELSE {_leaf_sql('text')} END AS changed FROM documents, crc_table),
base AS (SELECT doc_id, coalesce('s' || source, '') AS tree, leaf AS h, changed,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
{_GROW_SQL.format(name='trees', base='base')},
subs AS (SELECT tree AS of, h, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM trees WHERE n = 1),
{_GROW_SQL.format(name='tops', base='subs')},
{_BESIDE_SQL.format(name='beside', trees='trees')},
{_BESIDE_SQL.format(name='beside_top', trees='tops')},
steps AS (SELECT tree AS of, level, pos, l, r FROM beside WHERE n > 1),
fold(of, seat, level, pos, in_top, h, proof) AS (
  SELECT tree, pos, 0, pos, false, changed, '' FROM base
  UNION ALL SELECT f.of, f.seat, CASE WHEN s.of IS NULL AND NOT f.in_top THEN 0 ELSE f.level + 1 END,
    CASE WHEN s.of IS NULL AND NOT f.in_top THEN u.pos ELSE f.pos // 3 END, f.in_top OR s.of IS NULL,
    CASE WHEN f.in_top THEN sha256(t.l || f.h || t.r) WHEN s.of IS NULL THEN f.h ELSE sha256(s.l || f.h || s.r) END,
    f.proof || CASE WHEN f.in_top THEN t.l || t.r ELSE coalesce(s.l || s.r, '') END
  FROM fold f JOIN subs u USING (of)
  LEFT JOIN steps s ON NOT f.in_top AND f.of = s.of AND f.level = s.level AND f.pos = s.pos
  LEFT JOIN beside_top t ON f.in_top AND t.n > 1 AND f.level = t.level AND f.pos = t.pos
  WHERE NOT f.in_top OR t.level IS NOT NULL),
result AS (SELECT of, seat, max_by(h, level) AS h, max_by(proof, level) AS proof FROM fold WHERE in_top GROUP BY of, seat)
SELECT b.doc_id, b.h AS leaf, s.h AS subroot, t.h AS root, sha256(r.proof) AS proof_sha256, r.h AS folded_root, r.h = t.h AS verified
FROM base b JOIN result r ON b.tree = r.of AND b.pos = r.seat JOIN subs s ON s.of = b.tree JOIN tops t ON t.n = 1"""
