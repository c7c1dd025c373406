"""Repair of conversations and their prefix trie against brute force."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from heronlake.llm import catalog, repair, trie
from heronlake.sources.views import Tables
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, copy int, _n long, block int"
WHITE = " \t\n\x0b\x0c\r"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS)


def odd_turns():
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Ho!"), (1, 1, "assistant", "Ho!"), (1, None, "system", "be kind"), (2, 3, None, "x."),
        (2, 4, "user", None), (2, 9, None, None), (None, 1, "user", "no id."), (None, None, "assistant", "none"), (3, 0, "user", ""),
        (4, 0, "robot", "unknown?"), (4, 1, "", "no role."), (5, 5, "user", "long. " * 30_000), (5, 6, "assistant", "end"), (-7, 0, "user", "\t\x0b "),
        (-7, 1, "user", "Ünïcode \U0001f600!"), (-6, 2, "system", "a."), (-6, 2, "user", "b."), (-6, 3, "assistant", "c."), (11, None, None, None),
    ]
    return rows


def made_turns(seed, convs=60):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool"])
            rows.append((c, turn + rng.randrange(2), role, rng.choice(["One.", "Two", "three?", "", "four!", "x" * 3, "Five. "])))
    return rows


def key(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), text.encode())


def hurt(rows):
    out = []
    for c, turn, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        hit = zlib.crc32(f"{s(c)}:{s(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(x for x in text if x not in ".!?")
        if hit == 4:
            role = "user"
        out += [(c, turn, role, text)] * (2 if hit == 3 else 1)
    return out


def legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(rest) >= 2 and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def plain_repair(rows):
    """Dijkstra-free search: the cheapest, then least, audit over (row, initials state), strings compared whole."""
    rows = sorted(rows, key=key)
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "none")
        seen.add((role, text))
    move = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}
    # states from the last row back; value: (cost, audit, texts)
    best = {"": (0, "", ()), "a": (0, "", ())}

    def insertions(level):
        for _ in range(6):
            for state in ("", "s", "u", "a"):
                for r in "ua":
                    to = move.get((state, r))
                    if to in level:
                        cost, audit, out = level[to]
                        new = (cost + 5, "I" + audit, (f"{full[r]}:", *out))
                        if state not in level or new[:2] < level[state][:2]:
                            level[state] = new
        return level

    best = insertions(best)
    for (_, _, role, text), what in reversed(list(zip(rows, faults))):
        level = {}
        for state in ("", "s", "u", "a"):
            ways = []
            if state in best:
                cost, audit, out = best[state]
                ways.append((cost + 2, "D" + audit, out))
            if what not in ("blank", "duplicate"):
                extra = 5 if what == "truncated" else 0
                for op, more, name in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    to = move.get((state, name[:1]))
                    if to in best:
                        cost, audit, out = best[to]
                        ways.append((cost + more + extra, op + audit, (f"{name}:{text}", *out)))
            if ways:
                level[state] = min(ways, key=lambda w: w[:2])
        best = insertions(level)
    cost, audit, out = best[""]
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def plain_report(rows, damage=True):
    after = hurt(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    return sorted(((c, *plain_repair([r for r in after if r[0] == c])) for c in {r[0] for r in rows}), key=str)


def report(turns, **more):
    return sorted((tuple(r) for r in repair.repair_conversations(turns, **more).collect()), key=str)


@pytest.mark.parametrize("damage", [True, False])
def test_repair_of_odd_turns(spark, damage):
    assert report(table(spark, odd_turns()), damage=damage) == plain_report(odd_turns(), damage)
    assert report(table(spark, []), damage=damage) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair_of_made_turns(spark, seed):
    rows = made_turns(seed)
    assert report(table(spark, rows)) == plain_report(rows)


def test_every_short_conversation_is_repaired_at_least_cost():
    """All conversations of up to four rows, against trying all edits."""
    kinds = [(r, t) for r in ("system", "user", "assistant", "x") for t in ("a.", "b")]
    for n in range(5):
        for rows in itertools.islice(itertools.product(kinds, repeat=n), 0, None, 1 if n < 4 else 7):
            marked = [(0, i, r, f"{i}{t}") for i, (r, t) in enumerate(rows)]
            now = repair.Conversation(0)
            for _, i, r, t in reversed(marked):
                now.add(i, r, t, "none" if t.endswith(".") else "truncated")
            got = now.done()
            want = plain_repair(marked)
            assert (got["cost"], got["audit"], got["repaired_sha256"]) == want[5:], rows


def test_long_conversation_is_paged_out(spark):
    """More turns than a page and than a batch: state goes on, pages come back from the spill file."""
    rng = random.Random(4)
    roles = ["user", "assistant"] * 15_000
    rows = [(1, i, r if rng.random() < 0.97 else "user", f"turn {i}" + rng.choice([".", ".", ""]) + " " * rng.randrange(600)) for i, r in enumerate(roles)]
    got = report(table(spark, rows))
    after = sorted(hurt(rows), key=key)
    audit = got[0][7]
    assert len(audit) - audit.count("I") == len(after)
    left, at, cost = [], 0, 0
    for op in audit:
        if op == "I":
            left.append("ua"[len(left) % 2] + ":")
            cost += 5
            continue
        _, _, role, text = after[at]
        at += 1
        cost += {"D": 2, "R": 1, "K": 0}[op]
        if op != "D":
            cost += 0 if text.rstrip(WHITE)[-1:] in ".!?" else 5
            left.append((role if op == "K" else ["user", "assistant"][len(left) % 2]) + ":" + text)
    assert legal("".join(x[0] for x in left)) and cost == got[0][6]
    full = [x if len(x) > 2 else {"u:": "user:", "a:": "assistant:"}[x] for x in left]
    assert hashlib.sha256("\n".join(full).encode()).hexdigest() == got[0][8]


def rebuilt(rows, family=True):
    convs = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    if not family:
        return convs
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {n: [m for m in nodes if len(m) == len(n) + 1 and m[:-1] == n] for n in nodes}

    def below(n):
        leaves, saved = int(not children[n]), (len(nodes[n]) - 1) * len(n[-1][1].encode()) if n else 0
        for m in children[n]:
            a, b = below(m)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for n, members in nodes.items():
        ends = sorted(c for c in members if len(convs[c]) == len(n))
        out.append((
            min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(children[n]), *below(n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def nodes(turns, **more):
    return sorted((tuple(r) for r in trie.prefix_trie(turns, **more).collect()), key=str)


@pytest.mark.parametrize("family", [True, False])
def test_trie_of_odd_turns(spark, family):
    assert nodes(table(spark, odd_turns()), rebuild=family) == plain_trie(rebuilt(odd_turns(), family))
    assert nodes(table(spark, []), rebuild=family) == []


def test_trie_of_shared_and_long_conversations(spark):
    """Shared starts over several blocks of columns, conversations without turns after the rebuild, equal ones."""
    rng, rows = random.Random(8), []
    for c in range(-12, 60):
        size = rng.choice([1, 1, 2, 3, 8, 9, 16, 17, 30])
        split = rng.randrange(size + 1)
        for i in range(size):
            rows.append((c, i, "user" if i % 2 == 0 else "assistant", f"turn {i}" if i < split else f"turn {i} of {c % 4}"))
    rows = [r for r in rows if r[0] % 5 or r[0] % 2]
    for family in (True, False):
        convs = rebuilt(rows, family)
        assert any(not t for t in convs.values()) or not family
        assert nodes(table(spark, rows), rebuild=family) == plain_trie(convs)


def test_ids_of_one_node_come_in_pieces(spark):
    turns = spark.range(-9000, 9000).select(
        F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("same").alias("text")
    )
    got = nodes(turns, rebuild=False)
    ends = hashlib.sha256(",".join(str(i) for i in range(-9000, 9000)).encode()).hexdigest()
    assert got == sorted([(-9000, 0, None, 18000, 1, 1, 17999 * 4, hashlib.sha256(b"").hexdigest()), (-9000, 1, -9000, 18000, 0, 1, 17999 * 4, ends)], key=str)


def test_queries_on_the_small_tables(spark):
    t = Tables(spark, SMALL)
    rows = [tuple(r) for r in t.conversations.select("conv_id", "turn", "role", "text").collect()]
    found = catalog.QUERIES["op12_conversation_repair"](t)
    assert sorted(map(tuple, found.collect()), key=str) == plain_report(rows)
    assert compare(found, connect(SMALL), catalog.SQL["op12_conversation_repair"]) is None
    found = catalog.QUERIES["op13_conversation_trie"](t)
    assert sorted(map(tuple, found.collect()), key=str) == plain_trie(rebuilt(rows))
    assert compare(found, connect(SMALL), catalog.SQL["op13_conversation_trie"]) is None


@pytest.mark.parametrize("rows", [odd_turns(), made_turns(1), made_turns(2)])
def test_the_statement_of_the_repair_equals_brute_force(rows):
    con = duckdb.connect()
    con.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    got = con.execute(f"select {names} from ({catalog.SQL['op12_conversation_repair']})").fetchall()
    assert sorted(got, key=str) == plain_report(rows)
