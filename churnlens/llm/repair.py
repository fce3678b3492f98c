"""Repair of conversation structure: faults, cheapest edits and their audit.

Rows of a conversation are kept, given another role, deleted, or an empty turn
is inserted, so that roles read ``(system? (user assistant)+)?`` at the least
cost. The audit is the edits' initials in order; of equally cheap audits the
ASCII-least is taken.

The search is a dynamic program over rows with four states (what the last kept
turn was). Its audits are persistent: an edit is one node linked to its prefix,
so states share their prefixes. A node holds a rolling hash and its ancestors at
powers of two. A tie is decided by searching the longest common prefix with
them; what the hashes call equal is then compared, so a collision decides
nothing.

A conversation may hold a third of all rows. Its rows get positions through a
range partitioning and are cut into chunks of ``CHUNK``. The chunks are solved
side by side, a later one for each state that it may start in, and a chunk sends
one cost and audit per pair of states. Joined in order, these give the whole
audit: at a chunk's end, audits hold the same number of row edits and end in one,
so none is a prefix of another, and their order is kept as a rank. The texts then
pass once, a row at a time, into the hash of the repaired conversation; as a
digest is a chain, the texts of one conversation pass through one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import CRC_TABLE_SQL, crc32_sql, ranked, written

#: Rows of a conversation that one search holds.
CHUNK = 1024
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: States: nothing kept, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or re-roled turn.
NEXT = (USER, USER, ASSISTANT, USER)
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
SPACE = " \t\n\x0b\x0c\r"
MOD, BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Strings as linked nodes; node 0 is the empty string."""

    def __init__(self, mod: int = MOD, base: int = BASE):
        self.mod, self.base = mod, base
        self.up, self.char, self.depth, self.hash = [()], [""], [0], [0]

    def add(self, prefix: int, char: str) -> int:
        up, j = [prefix], 0
        while j < len(self.up[up[j]]):  # the ancestor 2^j up has one 2^j further up
            up.append(self.up[up[j]][j])
            j += 1
        self.up.append(tuple(up))
        self.char.append(char)
        self.depth.append(self.depth[prefix] + 1)
        self.hash.append((self.hash[prefix] * self.base + ord(char)) % self.mod)
        return len(self.up) - 1

    def lift(self, node: int, depth: int) -> int:
        """The prefix of that length."""
        while self.depth[node] > depth:
            j = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][min(j, len(self.up[node]) - 1)]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _equal(self, x: int, y: int) -> bool:
        while x != y:
            if self.char[x] != self.char[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether x's string comes before y's."""
        if x == y:
            return False
        short = min(self.depth[x], self.depth[y])
        a, b = self.lift(x, short), self.lift(y, short)
        if self.hash[a] == self.hash[b]:
            if self._equal(a, b):
                return self.depth[x] < self.depth[y]
            return self.text(x) < self.text(y)
        for j in range(len(self.up[a]) - 1, -1, -1):  # to the shortest prefixes that differ
            if j < len(self.up[a]) and self.hash[self.up[a][j]] != self.hash[self.up[b][j]]:
                a, b = self.up[a][j], self.up[b][j]
        if self._equal(self.up[a][0], self.up[b][0]):
            return self.char[a] < self.char[b]
        return self.text(x) < self.text(y)


def _better(audits: Audits, new: tuple[int, int], old: tuple[int, int] | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and audits.less(new[1], old[1]))


def _inserted(audits: Audits, best: list) -> list:
    """States after any inserts."""
    best = list(best)
    for _ in range(2):  # two inserts lead from any state through user to assistant
        for state in (START, SYSTEM, ASSISTANT, USER):
            if best[state]:
                cost, node = best[state]
                old = best[NEXT[state]]
                if old is None or cost + COST[INSERT] <= old[0]:
                    new = cost + COST[INSERT], audits.add(node, INSERT)
                    if _better(audits, new, old):
                        best[NEXT[state]] = new
    return best


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


def solve(rows: list[tuple[str, int]], start: int, audits: Audits | None = None) -> list:
    """The cheapest (cost, audit) that leads from ``start`` to each state over
    rows (role initial, fault); inserts stand before rows only."""
    audits = audits or Audits()
    best: list = [None] * 4
    best[start] = 0, 0
    for initial, fault in rows:
        before, best = _inserted(audits, best), [None] * 4
        extra = fault == TRUNCATED
        for state, held in enumerate(before):
            if held is None:
                continue
            edits = [(DELETE, state, COST[DELETE])]
            if fault not in (BLANK, DUPLICATE):
                edits.append((REROLE, NEXT[state], COST[REROLE] + extra))
                to = _kept(state, initial)
                if to is not None:
                    edits.append((KEEP, to, COST[KEEP] + extra))
            for char, to, cost in edits:
                old = best[to]
                if old is None or held[0] + cost <= old[0]:
                    new = held[0] + cost, audits.add(held[1], char)
                    if _better(audits, new, old):
                        best[to] = new
    return [b and (b[0], audits.text(b[1])) for b in best]


class Joined:
    """Chunks in order -> the whole conversation's cheapest audit."""

    def __init__(self):
        self.best: list = [(0, None, 0), None, None, None]  # cost, linked segments, rank

    def add(self, table: list[list]):
        """``table[m][t]``: (cost, audit) of a chunk from state m to t, or None."""
        found: list = [None] * 4
        for m, held in enumerate(self.best):
            for t in range(4):
                if held and table[m] and table[m][t]:
                    cost, audit = table[m][t]
                    new = held[0] + cost, held[2], audit, held[1]
                    if found[t] is None or new[:2] < found[t][:2]:
                        found[t] = new
        order = sorted((f[1], f[2]) for f in found if f)
        self.best = [f and (f[0], (f[3], f[2]), order.index((f[1], f[2]))) for f in found]

    def result(self) -> tuple[int, str]:
        ends = {START: "", SYSTEM: INSERT * 2, USER: INSERT, ASSISTANT: ""}
        cost, _, state = min((b[0] + COST[INSERT] * len(ends[s]), b[2], s) for s, b in enumerate(self.best) if b)
        parts, link = [ends[state]], self.best[state][1]
        while link:
            link, audit = link
            parts.append(audit)
        return cost, "".join(reversed(parts))


def damaged(rows: DataFrame) -> DataFrame:
    """conv, turn, role and text of rows after the damage that the crc32 of
    ``conv_id:turn`` modulo 20 chooses; nulls of any column count as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    said = text("text")
    hit = rows.select(
        _conv("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(text("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"), kind.alias("kind"))
    return hit.where("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                                                               .otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def _conv(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("c"), F.col(c).cast("string")), F.lit("")).alias("conv")


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


_CHUNK = ("conv string, chunk long, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, "
          "first string, last string, cost array<long>, audit array<string>")
_KINDS = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
_CHUNK_ARROW = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _CHUNK.split(", ")])
LEGAL = {"su", "ua", "au"}


def _chunk_rows(key, rows: list[tuple]) -> tuple:
    """One row of _CHUNK for rows (turn, initial, fault) in order."""
    conv, chunk = key
    faults = [f for *_, f in rows]
    initials = [i for _, i, _ in rows]
    turns = [t for t, *_ in rows if t is not None]
    plain = [(i, f) for _, i, f in rows]
    table = [solve(plain, s) if s == START or chunk else [None] * 4 for s in range(4)]
    flat = [e for line in table for e in line]
    return (conv, chunk, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])),
            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), initials[0], initials[-1],
            [e and e[0] for e in flat], [e and e[1] for e in flat])


def _chunks(batches):
    at, held, out = None, [], []

    def table():
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _CHUNK_ARROW)], schema=_CHUNK_ARROW)

    for batch in batches:
        for conv, chunk, turn, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv", "chunk", "turn", "initial", "fault"))):
            if (conv, chunk) != at:
                if held:
                    out.append(_chunk_rows(at, held))
                    if len(out) >= 256:
                        yield table()
                        out.clear()
                at, held = (conv, chunk), []
            held.append((turn, initial, fault))
    if held:
        out.append(_chunk_rows(at, held))
    if out:
        yield table()


_OUT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_OUT_ARROW = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _OUT.split(", ")])


class _Conversation:
    def __init__(self, conv: str):
        self.conv, self.joined, self.counts, self.audit = conv, Joined(), [0, 0, 0, 0], None
        self.low = self.high = self.last = None
        self.turns, self.sha, self.said, self.at = 0, hashlib.sha256(), 0, 0

    def chunk(self, r: dict):
        for i, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.counts[i] += r[c]
        if self.last is not None:
            self.counts[3] += self.last + r["first"] not in LEGAL
        self.last = r["last"]
        if r["low"] is not None:
            self.turns += r["turns"] - (self.high == r["low"])
            self.low = r["low"] if self.low is None else self.low
            self.high = r["high"]
        flat = [None if c is None else (c, a) for c, a in zip(r["cost"], r["audit"])]
        self.joined.add([flat[i:i + 4] for i in (0, 4, 8, 12)])

    def finish(self):
        self.cost, self.audit = self.joined.result()
        edits = len(self.audit) - self.audit.count(DELETE)
        self.system = edits % 2  # an odd number of turns starts with a kept system turn

    def _say(self, role: str, text: str):
        self.sha.update((("\n" if self.said else "") + role + ":" + text).encode())
        self.said += 1

    def _inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self._say(self._role(), "")
            self.at += 1

    def _role(self) -> str:
        return "assistant" if (self.said - self.system) % 2 else "user"

    def row(self, role: str, text: str):
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self._say(role, text)
        elif edit == REROLE:
            self._say(self._role(), text)

    def result(self) -> tuple:
        self._inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts, self.cost, self.audit, self.sha.hexdigest())


def _repaired(batches):
    """A conversation's row of kind 0, its chunks (1), then its rows (2)."""
    now, out = None, []

    def table():
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _OUT_ARROW)], schema=_OUT_ARROW)

    def close():
        if now.audit is None:
            now.finish()
        out.append(now.result())

    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            for r in batch.slice(i, 256).to_pylist():
                if r["kind"] == 0:
                    if now:
                        close()
                    now = _Conversation(r["conv"])
                elif r["kind"] == 1:
                    now.chunk(r)
                else:
                    if now.audit is None:
                        now.finish()
                    now.row(r["role"], r["text"])
            if len(out) >= 256:
                yield table()
                out.clear()
    if now:
        close()
    if out:
        yield table()


def repair(rows: DataFrame, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of every conversation of ``conversations`` (conv), from
    ``rows`` (conv, turn, role, text), which hold no nulls but in turn.

    Rows stand by turn, nulls first; rows of one turn by the hash of role and
    text, so equal rows are adjacent. A conversation without rows has zeros, an
    empty audit and the hash of nothing. Texts may be of any length; of a role
    only the first character counts for the order of turns.
    """
    rows = rows.withColumn("digest", _digest())
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    small = rows.select("conv", "turn", "digest", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
                        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    placed = ranked(small, "conv", ["turn", "digest"])
    again = written(placed.where("not blank").groupBy("conv", "digest").agg(F.min("pos").alias("head"), F.count(F.lit(1)).alias("k"))
                    .where("k > 1").select("conv", "digest", "head"), "repeated-turns")
    fault = (F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("head"), DUPLICATE)
             .when(F.col("cut"), TRUNCATED).otherwise(SOUND).alias("fault"))
    solved = (placed.join(again, ["conv", "digest"], "left")
              .select("conv", F.floor(F.col("pos") / chunk).alias("chunk"), "pos", "turn", "initial", fault)
              .repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "pos").mapInArrow(_chunks, _CHUNK))
    columns = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in _CHUNK.split(", ") if not c.startswith("conv ")}
    columns |= {"turn": F.lit(None).cast("long"), "digest": F.lit(None).cast("binary"), "role": F.lit(None).cast("string"),
                "text": F.lit(None).cast("string")}

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        return df.select("conv", F.lit(kind).alias("kind"), *[F.col(c) if c in df.columns else v.alias(c) for c, v in columns.items()])

    return (shaped(conversations.select("conv").distinct(), 0).union(shaped(written(solved, "solved-chunks"), 1)).union(shaped(rows, 2))
            .repartition("conv").sortWithinPartitions("conv", "kind", "chunk", F.col("turn").asc_nulls_first(), "digest")
            .mapInArrow(_repaired, _OUT))


def repair_damaged(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Damages conversations (conv_id, turn, role, text) and repairs them: one
    row per conv_id, null ids being one conversation. An empty table gives an
    empty result; other columns are ignored, whatever their names."""
    found = repair(damaged(conversations), conversations.select(_conv("conv_id")), chunk)
    ident = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(conversations.schema["conv_id"].dataType)
    return found.select(ident.alias("conv_id"), *[c for c in found.columns if c != "conv"])


_BARE_SQL = "rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

SQL = f"""WITH RECURSIVE {CRC_TABLE_SQL},
marked AS (SELECT conv_id, coalesce('c' || conv_id, '') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations, crc_table),
copies AS (SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM marked WHERE kind <> 0),
digests AS (SELECT *, sha256(strlen(role) || ':' || role || text) AS digest FROM copies),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, digest) AS pos FROM digests),
turns AS (SELECT k, turn, role, text, pos, left(role, 1) AS initial, CASE WHEN {_BARE_SQL} = '' THEN 1
  WHEN pos > min(pos) OVER (PARTITION BY k, digest) THEN 2 WHEN right({_BARE_SQL}, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY k ORDER BY pos) AS before FROM placed),
inserts(f, t, a, c) AS (VALUES (0, 0, '', 0), (0, 2, 'I', 2), (0, 3, 'II', 4), (1, 1, '', 0), (1, 2, 'I', 2), (1, 3, 'II', 4),
  (2, 2, '', 0), (2, 3, 'I', 2), (3, 3, '', 0), (3, 2, 'I', 2)),
edits(f, t, initial, a, c) AS (VALUES (0, 0, NULL, 'D', 3), (1, 1, NULL, 'D', 3), (2, 2, NULL, 'D', 3), (3, 3, NULL, 'D', 3),
  (0, 2, NULL, 'R', 2), (1, 2, NULL, 'R', 2), (2, 3, NULL, 'R', 2), (3, 2, NULL, 'R', 2),
  (0, 1, 's', 'K', 0), (0, 2, 'u', 'K', 0), (1, 2, 'u', 'K', 0), (3, 2, 'u', 'K', 0), (2, 3, 'a', 'K', 0)),
best(k, pos, state, b) AS (SELECT DISTINCT k, 0::BIGINT, 0, {{'c': 0, 'a': ''}} FROM marked
  UNION ALL SELECT d.k, r.pos, e.t, min({{'c': d.b.c + n.c + e.c + CASE WHEN r.fault = 3 AND e.a <> 'D' THEN 1 ELSE 0 END,
    'a': d.b.a || n.a || e.a}})
  FROM best d JOIN turns r ON r.k = d.k AND r.pos = d.pos + 1 JOIN inserts n ON n.f = d.state
  JOIN edits e ON e.f = n.t AND (e.initial IS NULL OR e.initial = r.initial) AND (e.a = 'D' OR r.fault NOT IN (1, 2))
  GROUP BY d.k, r.pos, e.t),
stats AS (SELECT m.k, any_value(m.conv_id) AS conv_id FROM marked m GROUP BY m.k),
counts AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
  count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM turns GROUP BY k),
chosen AS (SELECT s.k, s.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, min({{'c': b.b.c + n.c, 'a': b.b.a || n.a}}) AS b
  FROM stats s LEFT JOIN counts c USING (k) JOIN best b ON b.k = s.k AND b.pos = coalesce(c.n, 0)
  JOIN inserts n ON n.f = b.state AND n.t IN (0, 3) GROUP BY ALL),
chars AS (SELECT k, unnest(range(1, length(b.a) + 1)) AS p, b.a AS audit FROM chosen),
acts AS (SELECT k, p, audit[p] AS act, count(*) FILTER (audit[p] <> 'I') OVER (PARTITION BY k ORDER BY p) AS pos,
  count(*) FILTER (audit[p] <> 'D') OVER (PARTITION BY k ORDER BY p) AS said,
  count(*) FILTER (audit[p] <> 'D') OVER (PARTITION BY k) % 2 AS system FROM chars),
written AS (SELECT a.k, string_agg(CASE WHEN act = 'K' THEN r.role WHEN (said - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
  CASE WHEN act = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY p) AS repaired
  FROM acts a LEFT JOIN turns r ON r.k = a.k AND r.pos = a.pos WHERE act <> 'D' GROUP BY a.k)
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, b.c AS cost, b.a AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM chosen LEFT JOIN written USING (k)"""
