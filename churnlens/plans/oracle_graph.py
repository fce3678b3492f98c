"""DuckDB SQL for the graph queries: CTE builders.

Iterated operators are unrolled into one CTE per round with the same round
count as the Spark side; components use a recursive CTE. Every builder
returns a list of (name, body) CTEs that ``with_views`` appends after the
derived views.
"""

from __future__ import annotations


def known(src_view: str = "edges", name: str = "K") -> list[tuple[str, str]]:
    return [(name, f"SELECT src, dst FROM {src_view} WHERE src IS NOT NULL AND dst IS NOT NULL")]


def pagerank_graphx(rounds: int, vertices: str = "V", k: str = "K", prefix: str = "PR") -> list[tuple[str, str]]:
    ctes = [(f"{prefix}W", f"SELECT {k}.src, {k}.dst, o.od FROM {k} JOIN "
             f"(SELECT src, count(*) AS od FROM {k} GROUP BY src) o ON o.src = {k}.src"),
            (f"{prefix}0", f"SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM {vertices}")]
    for i in range(1, rounds + 1):
        ctes.append((f"{prefix}{i}", f"""
SELECT v.id, CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * coalesce(c.s, CAST(0 AS DOUBLE)) AS rank
FROM {vertices} v LEFT JOIN (
  SELECT w.dst, sum(r.rank / w.od) AS s FROM {prefix}W w JOIN {prefix}{i-1} r ON r.id = w.src GROUP BY w.dst
) c ON c.dst = v.id"""))
    ctes.append((prefix, f"""
SELECT id, rank * (SELECT CAST(count(*) AS DOUBLE) FROM {prefix}{rounds}) / (SELECT sum(rank) FROM {prefix}{rounds}) AS pagerank
FROM {prefix}{rounds}"""))
    return ctes


def pagerank_nx(rounds: int, k: str = "K", prefix: str = "NP", alpha: float = 0.85) -> list[tuple[str, str]]:
    a = f"CAST({alpha} AS DOUBLE)"
    b = f"CAST({1.0 - alpha!r} AS DOUBLE)"
    ctes = [(f"{prefix}V", f"SELECT src AS id FROM {k} UNION SELECT dst FROM {k}"),
            (f"{prefix}N", f"SELECT CAST(count(*) AS DOUBLE) AS n FROM {prefix}V"),
            (f"{prefix}W", f"SELECT {k}.src, {k}.dst, o.od FROM {k} JOIN "
             f"(SELECT src, count(*) AS od FROM {k} GROUP BY src) o ON o.src = {k}.src"),
            (f"{prefix}S", f"SELECT id FROM {prefix}V WHERE id NOT IN (SELECT src FROM {k})"),
            (f"{prefix}0", f"SELECT id, CAST(1.0 AS DOUBLE) / (SELECT n FROM {prefix}N) AS rank FROM {prefix}V")]
    for i in range(1, rounds + 1):
        p = f"{prefix}{i-1}"
        ctes.append((f"{prefix}{i}", f"""
SELECT v.id, {a} * (coalesce(c.s, CAST(0 AS DOUBLE))
    + (SELECT coalesce(sum(r.rank), CAST(0 AS DOUBLE)) FROM {p} r JOIN {prefix}S s ON s.id = r.id) / (SELECT n FROM {prefix}N))
  + {b} / (SELECT n FROM {prefix}N) AS rank
FROM {prefix}V v LEFT JOIN (
  SELECT w.dst, sum(r.rank / w.od) AS s FROM {prefix}W w JOIN {p} r ON r.id = w.src GROUP BY w.dst
) c ON c.dst = v.id"""))
    ctes.append((prefix, f"SELECT id, rank AS pagerank FROM {prefix}{rounds}"))
    return ctes


def pagerank_active(tol: float = 0.01, vertices: str = "V", k: str = "K", prefix: str = "PA") -> list[tuple[str, str]]:
    """Residuals of at least one round after another until none is above the
    tolerance; a rank is all that a vertex received."""
    return [(f"{prefix}W", f"SELECT {k}.src, {k}.dst, o.od FROM {k} JOIN "
             f"(SELECT src, count(*) AS od FROM {k} GROUP BY src) o ON o.src = {k}.src"),
            (f"{prefix}D(round, id, delta)", f"""
SELECT 0, id, CAST(0.15 AS DOUBLE) FROM {vertices}
UNION ALL
SELECT d.round + 1, w.dst, CAST(0.85 AS DOUBLE) * sum(d.delta / w.od) FROM {prefix}D d JOIN {prefix}W w ON w.src = d.id
WHERE d.delta > CAST({tol} AS DOUBLE) GROUP BY d.round, w.dst"""),
            (f"{prefix}R", f"SELECT id, sum(delta) AS rank FROM {prefix}D GROUP BY id"),
            (prefix, f"SELECT id, rank * (SELECT CAST(count(*) AS DOUBLE) FROM {prefix}R) / (SELECT sum(rank) FROM {prefix}R) AS pagerank "
             f"FROM {prefix}R")]


def label_propagation(rounds: int, vertices: str = "V", k: str = "K", prefix: str = "LP") -> list[tuple[str, str]]:
    ctes = [(f"{prefix}E", f"SELECT dst AS tgt, src AS frm FROM {k} WHERE src <> dst "
             f"UNION ALL SELECT src AS tgt, dst AS frm FROM {k} WHERE src <> dst"),
            (f"{prefix}0", f"SELECT id, id AS label FROM {vertices}")]
    for i in range(1, rounds + 1):
        p = f"{prefix}{i-1}"
        ctes.append((f"{prefix}{i}", f"""
SELECT l.id, coalesce(b.label, l.label) AS label
FROM {p} l LEFT JOIN (
  SELECT tgt, label FROM (
    SELECT tgt, label, row_number() OVER (PARTITION BY tgt ORDER BY n DESC, label) AS rk
    FROM (SELECT e.tgt, l2.label, count(*) AS n FROM {prefix}E e JOIN {p} l2 ON l2.id = e.frm
          GROUP BY e.tgt, l2.label) m) x
  WHERE rk = 1) b ON b.tgt = l.id"""))
    ctes.append((prefix, f"SELECT id, label FROM {prefix}{rounds}"))
    return ctes


def components(vertices: str = "V", k: str = "K", name: str = "CC") -> list[tuple[str, str]]:
    """Min-label propagation as a keyed recursive CTE (needs WITH RECURSIVE)."""
    return [(f"{name}U", f"SELECT src AS u, dst AS v FROM {k} WHERE src <> dst "
             f"UNION SELECT dst, src FROM {k} WHERE src <> dst"),
            (f"{name}(id, component) USING KEY (id)", f"""
SELECT id, id FROM {vertices}
UNION
SELECT u.v AS id, min(c.component) AS component FROM {name} c JOIN {name}U u ON u.u = c.id
GROUP BY u.v
HAVING min(c.component) < (SELECT r.component FROM recurring.{name} r WHERE r.id = u.v)""")]


def simple_weighted(k: str = "K", name: str = "SW") -> list[tuple[str, str]]:
    return [(name, f"SELECT least(src, dst) AS u, greatest(src, dst) AS v, count(*) AS w "
             f"FROM {k} WHERE src <> dst GROUP BY 1, 2")]


def triangles(sw: str = "SW", name: str = "TRI") -> list[tuple[str, str]]:
    """Triangles a < b < c (string order) with their three pair weights."""
    return [(name, f"""
SELECT e1.u AS a, e1.v AS b, e2.v AS c, e1.w AS w_ab, e2.w AS w_bc, e3.w AS w_ac
FROM {sw} e1 JOIN {sw} e2 ON e2.u = e1.v JOIN {sw} e3 ON e3.u = e1.u AND e3.v = e2.v""")]


def triangle_counts(tri: str = "TRI", name: str = "TC") -> list[tuple[str, str]]:
    return [(name, f"SELECT id, count(*) AS triangles FROM (SELECT a AS id FROM {tri} "
             f"UNION ALL SELECT b FROM {tri} UNION ALL SELECT c FROM {tri}) t GROUP BY id")]


def directed_clustering(k: str = "K", sw: str = "SW", tri: str = "TRI", name: str = "DC") -> list[tuple[str, str]]:
    return [
        (f"{name}N", f"SELECT src AS id FROM {k} UNION SELECT dst FROM {k}"),
        (f"{name}D", f"SELECT id, sum(w) AS dt, count(*) FILTER (WHERE w = 2) AS db FROM "
         f"(SELECT u AS id, w FROM {sw} UNION ALL SELECT v, w FROM {sw}) t GROUP BY id"),
        (f"{name}T", f"SELECT id, 2 * sum(p) AS t FROM (SELECT a AS id, w_ab * w_bc * w_ac AS p FROM {tri} "
         f"UNION ALL SELECT b, w_ab * w_bc * w_ac FROM {tri} UNION ALL SELECT c, w_ab * w_bc * w_ac FROM {tri}) x GROUP BY id"),
        (name, f"""
SELECT n.id, CASE WHEN coalesce(t.t, 0) = 0 THEN CAST(0 AS DOUBLE)
  ELSE CAST(t.t AS DOUBLE) / CAST(2 * (d.dt * (d.dt - 1) - 2 * d.db) AS DOUBLE) END AS clustering
FROM {name}N n LEFT JOIN {name}D d ON d.id = n.id LEFT JOIN {name}T t ON t.id = n.id"""),
    ]


def degrees(k: str = "edges", name: str = "DEG") -> list[tuple[str, str]]:
    return [(name, f"""
SELECT id, count(*) AS degree, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree
FROM (SELECT src AS id, 0 AS i, 1 AS o FROM {k} UNION ALL SELECT dst AS id, 1 AS i, 0 AS o FROM {k}) t
WHERE id IS NOT NULL GROUP BY id""")]


def neighbour_avgs(e: str = "edges", attrs: str = "SILV", name: str = "NB", direction: str = "both") -> list[tuple[str, str]]:
    pairs = f"SELECT src AS id, dst AS nbgh FROM {e}"
    if direction == "both":
        pairs += f" UNION ALL SELECT dst AS id, src AS nbgh FROM {e}"
    return [(name, f"""
SELECT p.id, avg(a.monthly_charges) AS nghb_avg_monthly_charges,
  avg(a.total_charges) AS nghb_avg_total_charges, avg(a.tenure) AS nghb_avg_tenure
FROM ({pairs}) p LEFT JOIN {attrs} a ON a.customer_id = p.nbgh
WHERE p.id IS NOT NULL GROUP BY p.id""")]


def community_stats(labels: str = "LP", attrs: str = "SILV", name: str = "CS") -> list[tuple[str, str]]:
    return [(name, f"""
SELECT l.label, avg(a.monthly_charges) AS comm_avg_monthly_charges,
  avg(a.total_charges) AS comm_avg_total_charges, avg(a.tenure) AS comm_avg_tenure,
  count(l.id) AS comm_size
FROM {labels} l JOIN {attrs} a ON a.customer_id = l.id GROUP BY l.label""")]


def bfs(arcs_sql: str, nodes: str = "NV", name: str = "BFS") -> list[tuple[str, str]]:
    """All-sources BFS hop distances (s, v, d) over arcs (u, w); keyed
    recursive CTE (needs WITH RECURSIVE)."""
    return [(f"{name}A", arcs_sql),
            (f"{name}(s, v, d) USING KEY (s, v)", f"""
SELECT id, id, 0 FROM {nodes}
UNION
SELECT b.s, a.w, min(b.d) + 1 FROM {name} b JOIN {name}A a ON a.u = b.v
WHERE NOT EXISTS (SELECT 1 FROM recurring.{name} r WHERE r.s = b.s AND r.v = a.w)
GROUP BY b.s, a.w""")]
