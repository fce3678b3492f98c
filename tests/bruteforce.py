"""Plain-Python reference computations for small graphs (test oracles)."""

from __future__ import annotations

from collections import Counter, defaultdict, deque
from itertools import combinations


def known(edges):
    return [(s, d) for s, d in set(edges) if s is not None and d is not None]


def degrees(edges):
    deg, ind, outd = Counter(), Counter(), Counter()
    for s, d in set(edges):
        if s is not None:
            outd[s] += 1
            deg[s] += 1
        if d is not None:
            ind[d] += 1
            deg[d] += 1
    return deg, ind, outd


def undirected_simple(edges):
    adj = defaultdict(set)
    for s, d in known(edges):
        if s != d:
            adj[s].add(d)
            adj[d].add(s)
    return adj


def triangles(edges):
    adj = undirected_simple(edges)
    t = Counter()
    for a, b, c in combinations(sorted(adj), 3):
        if b in adj[a] and c in adj[a] and c in adj[b]:
            t[a] += 1
            t[b] += 1
            t[c] += 1
    return t


def directed_clustering(edges):
    arcs = {(s, d) for s, d in known(edges) if s != d}
    nodes = {x for e in known(edges) for x in e}

    def a(i, j):
        return 1 if (i, j) in arcs else 0

    out = {}
    for i in nodes:
        t = 0
        for j in nodes:
            for k in nodes:
                if len({i, j, k}) < 3:
                    continue
                t += (a(i, j) + a(j, i)) * (a(j, k) + a(k, j)) * (a(k, i) + a(i, k))
        dt = sum(a(i, j) + a(j, i) for j in nodes if j != i)
        db = sum(1 for j in nodes if j != i and a(i, j) and a(j, i))
        out[i] = 0.0 if t == 0 else t / (2 * (dt * (dt - 1) - 2 * db))
    return out


def pagerank_graphx(vertices, edges, rounds, reset=0.15, normalise=True):
    k = known(edges)
    outd = Counter(s for s, _ in k)
    r = {v: 1.0 for v in vertices}
    for _ in range(rounds):
        s = Counter()
        for a, b in k:
            s[b] += r[a] / outd[a]
        r = {v: reset + (1 - reset) * s.get(v, 0.0) for v in vertices}
    if normalise:
        tot = sum(r.values())
        r = {v: x * len(r) / tot for v, x in r.items()}
    return r


def pagerank_nx(edges, rounds, alpha=0.85):
    k = known(edges)
    nodes = {x for e in k for x in e}
    n = len(nodes)
    outd = Counter(s for s, _ in k)
    x = {v: 1.0 / n for v in nodes}
    for _ in range(rounds):
        sink = sum(x[v] for v in nodes if outd[v] == 0)
        s = Counter()
        for a, b in k:
            s[b] += x[a] / outd[a]
        x = {v: alpha * (s.get(v, 0.0) + sink / n) + (1 - alpha) / n for v in nodes}
    return x


def label_propagation(vertices, edges, rounds):
    votes = defaultdict(list)
    for s, d in known(edges):
        if s != d:
            votes[d].append(s)
            votes[s].append(d)
    lab = {v: v for v in vertices}
    for _ in range(rounds):
        new = {}
        for v in vertices:
            if votes[v]:
                c = Counter(lab[u] for u in votes[v])
                best = max(c.values())
                new[v] = min(l for l, n in c.items() if n == best)
            else:
                new[v] = lab[v]
        lab = new
    return lab


def components(vertices, edges):
    adj = undirected_simple(edges)
    comp = {}
    for v in sorted(vertices):
        if v in comp:
            continue
        seen, q = {v}, deque([v])
        while q:
            x = q.popleft()
            for y in adj[x]:
                if y not in seen:
                    seen.add(y)
                    q.append(y)
        m = min(seen)
        for x in seen:
            comp[x] = m
    return comp


def bfs(adj, s):
    dist = {s: 0}
    q = deque([s])
    while q:
        x = q.popleft()
        for y in adj[x]:
            if y not in dist:
                dist[y] = dist[x] + 1
                q.append(y)
    return dist


def closeness(edges):
    k = known(edges)
    nodes = {x for e in k for x in e}
    radj = defaultdict(set)
    for s, d in k:
        if s != d:
            radj[d].add(s)
    n = len(nodes)
    out = {}
    for u in nodes:
        dist = bfs(radj, u)
        tot = sum(dist.values())
        r = len(dist)
        out[u] = ((r - 1) / tot) * ((r - 1) / (n - 1)) if tot > 0 and n > 1 else 0.0
    return out


def betweenness(edges, normalized=True):
    """Count, for every ordered pair (s, t), the share of shortest s-t paths
    through each intermediate vertex (explicit path enumeration)."""
    k = known(edges)
    nodes = sorted({x for e in k for x in e})
    adj = defaultdict(set)
    for s, d in k:
        if s != d:
            adj[s].add(d)
    b = {v: 0.0 for v in nodes}

    def all_paths(s, t, dist):
        if s == t:
            return [[s]]
        out = []
        for p in nodes:
            if t in adj[p] and dist.get(p) == dist[t] - 1:
                out += [path + [t] for path in all_paths(s, p, dist)]
        return out

    for s in nodes:
        dist = bfs(adj, s)
        for t in nodes:
            if t == s or t not in dist:
                continue
            ps = all_paths(s, t, dist)
            for p in ps:
                for v in p[1:-1]:
                    b[v] += 1.0 / len(ps)
    n = len(nodes)
    if normalized and n > 2:
        b = {v: x / ((n - 1) * (n - 2)) for v, x in b.items()}
    return b


def distance_summary(edges):
    k = known(edges)
    nodes = {x for e in k for x in e}
    adj = undirected_simple(edges)
    pairs, maxd, sumd = 0, 0, 0
    for s in nodes:
        for t, d in bfs(adj, s).items():
            if d > 0:
                pairs += 1
                maxd = max(maxd, d)
                sumd += d
    n = len(nodes)
    return {"n_nodes": n, "n_pairs": pairs, "max_distance": maxd, "sum_distance": sumd,
            "is_connected": pairs == n * (n - 1)}
