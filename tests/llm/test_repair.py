import hashlib
import random
import zlib
from heapq import heappop, heappush

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm.repair import Audits, Joined, repair_damaged, solve

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """Cheapest (cost, audit) by search over whole strings, rows (initial, fault)."""
    step = {0: 2, 1: 2, 2: 3, 3: 2}
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, at, state = heappop(heap)
        if at == len(rows) and state in (0, 3):
            return cost, audit
        if (audit, at, state) in seen or audit.endswith("III"):
            continue
        seen.add((audit, at, state))
        heappush(heap, (cost + 2, audit + "I", at, step[state]))
        if at == len(rows):
            continue
        initial, fault = rows[at]
        heappush(heap, (cost + 3, audit + "D", at + 1, state))
        if fault not in (1, 2):
            more = fault == 3
            heappush(heap, (cost + 2 + more, audit + "R", at + 1, step[state]))
            kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, state))
            if kept is not None:
                heappush(heap, (cost + more, audit + "K", at + 1, kept))


def joined(rows, size):
    j = Joined()
    for at in range(0, len(rows), size):
        j.add([solve(rows[at:at + size], s) if s == 0 or at else [None] * 4 for s in range(4)])
    return j.result()


ROWS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.sampled_from([0, 0, 0, 1, 2, 3])), max_size=7)


@settings(max_examples=300, deadline=None)
@given(ROWS, st.integers(1, 8))
def test_cheapest_and_least_audit(rows, size):
    assert joined(rows, size) == brute(rows)


def test_chunks_give_the_same_as_one():
    rng = random.Random(3)
    rows = [(rng.choice("suuaat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(900)]
    assert joined(rows, 1000) == joined(rows, 7) == joined(rows, 128)


@pytest.mark.parametrize("mod", [(1 << 61) - 1, 1, 2, 7])  # small moduli: hashes collide all the time
def test_order_of_linked_strings(mod):
    rng, a = random.Random(8), Audits(mod)
    nodes, text = [0], {0: ""}
    for _ in range(400):
        prefix, c = rng.choice(nodes[-30:]), rng.choice("DIKR")
        nodes.append(a.add(prefix, c))
        text[nodes[-1]] = text[prefix] + c
    for _ in range(3000):
        x, y = rng.choice(nodes), rng.choice(nodes)
        assert a.text(x) == text[x] and a.less(x, y) == (text[x] < text[y])
        d = rng.randint(0, len(text[x]))
        assert text[a.lift(x, d)] == text[x][:d]


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        mine = convs.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0,
                                 hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in mine:
            bare = text.rstrip(SPACE)
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = {t for t, *_ in mine if t is not None}
        roles = [r[1][:1] for r in mine]
        cost, audit = joined(list(zip(roles, faults)), 10_000)
        said, at, odd = [], 0, (len(audit) - audit.count("D")) % 2
        for c in audit:
            turn = ["user", "assistant"][(len(said) - odd) % 2]
            if c == "I":
                said.append(f"{turn}:")
                continue
            _, role, text = mine[at]
            at += 1
            if c != "D":
                said.append(f"{role if c == 'K' else turn}:{text}")
        out.append((str(conv), max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                    sum(x + y not in ("su", "ua", "au") for x, y in zip(roles, roles[1:])), cost, audit,
                    hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out)


def conversations(spark, rows):
    return spark.createDataFrame([(9, *r, "x", 1) for r in rows], "pos int, conv_id long, turn long, role string, text string, conv string, n int"
                                 ).repartition(4)


@pytest.mark.parametrize("chunk", [1024, 5])
def test_whole_query(spark, chunk):
    rng = random.Random(4)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.choice([0, 1, 2, 5, 9, 40])):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), rng.choice(["user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Hi.", "Yes?", "no", " \t", "", None, "x. \n", "y" * 5000 + "!", "Hi."])))
    rows += [(5, 3, "user", "Twice.")] * 3  # repeated rows
    got = repair_damaged(conversations(spark, rows), chunk)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == expected(rows)


def test_one_conversation_holds_a_third(spark):
    rows = [(0, t, "user" if t % 2 else "assistant", f"Text {t % 50}.") for t in range(3000)]
    rows += [(1 + t // 6, t % 6, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(6000)]
    got = repair_damaged(conversations(spark, rows))
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == expected(rows)


def test_all_rows_dropped(spark):
    gone = next((c, t) for c in range(99) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    row, = repair_damaged(conversations(spark, [(*gone, "user", "Hello.")])).collect()
    assert tuple(row) == (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty(spark):
    assert repair_damaged(conversations(spark, [(1, 1, "user", "x")]).where("false")).count() == 0
