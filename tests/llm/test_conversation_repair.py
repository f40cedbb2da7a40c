"""Conversation repair against a search over all edits and an unrolled shortest path."""

import hashlib
import heapq
import os
import random
import zlib
from itertools import product

import pytest

from citeloom.llm import conversation_repair as cr
from citeloom.llm import queries
from tests.llm.test_queries import SF_DIR

SPACE = " \t\n\v\f\r"


def legal(roles):
    return not roles or (roles[0] == "s" and len(roles) > 1 and legal(roles[1:]) or len(roles) % 2 == 0 and roles == "ua" * (len(roles) // 2))


def all_edits(rows):
    """The least ``(cost, audit)`` over every list of edits with few insertions; rows are ``(initial, must go, truncated)``."""
    best = None
    gaps = [("", "u", "a", "ua", "au")] * (len(rows) + 1)
    choices = []
    for x, gone, cut in rows:
        extra = 3 if cut else 0
        choices.append([(4, "D", "")] + ([] if gone else [(extra, "K", x), (3 + extra, "R", "u"), (3 + extra, "R", "a")]))
    for taken in product(*choices):
        for filled in product(*gaps):
            roles, audit, cost = filled[0], "I" * len(filled[0]), 3 * len(filled[0])
            for (c, letter, role), more in zip(taken, filled[1:], strict=True):
                roles, audit, cost = roles + role + more, audit + letter + "I" * len(more), cost + c + 3 * len(more)
            if legal(roles):
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def shortest_path(rows):
    """The same for longer conversations: Dijkstra over (rows done, last role)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, k, last = heapq.heappop(heap)
        if k == len(rows) and last in ("", "a"):
            return cost, audit
        if (k, last) in seen:
            continue
        seen.add((k, last))
        for role in "sua":
            if role not in {"": "su", "s": "u", "u": "a", "a": "u"}[last]:
                continue
            if role != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", k, role))
            if k < len(rows) and not rows[k][1]:
                extra = 3 if rows[k][2] else 0
                if rows[k][0] == role:
                    heapq.heappush(heap, (cost + extra, audit + "K", k + 1, role))
                if role != "s":
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", k + 1, role))
        if k < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, last))
    raise AssertionError


def random_rows(rng, n):
    return [(rng.choice("suauax"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


def charted(rows):
    return cr.cheapest(cr.Chart().cell("".join(cr.symbol(x, gone, cut) for x, gone, cut in rows)))


def test_chart_against_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 1, 2, 2, 3, 3, 3, 4, 4):
        for _ in range(12 if n < 4 else 3):
            rows = random_rows(rng, n)
            assert charted(rows) == all_edits(rows), rows


def test_chart_against_shortest_paths():
    rng = random.Random(2)
    for n in [*range(0, 40), 100, 257, 1000]:
        for _ in range(20 if n < 40 else 2):
            rows = random_rows(rng, n)
            assert charted(rows) == shortest_path(rows), rows


def test_every_split_gives_the_same_cell():
    rng, chart = random.Random(3), cr.Chart()
    for _ in range(60):
        s = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(2, 30)))
        k = rng.randrange(1, len(s))
        assert cr.joined(chart.cell(s[:k]), chart.cell(s[k:])) == chart.cell(s)


def brute(rows):
    """All columns of one conversation, from rows ``(turn, role, text)`` in any order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    mark = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), mark(r)))
    seen, facts, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        said = text.rstrip(SPACE)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            n[fault] += 1
        facts.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = shortest_path(facts)
    out, left, size = [], iter(rows), len(audit.replace("D", ""))
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(left)[1:]
        if edit != "D":
            made = role if edit == "K" else ("user", "assistant")[(len(out) - size % 2) % 2]
            out.append((made, text))
    assert legal("".join(r[:1] for r, _ in out))
    return (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit), out


def spark_repair(spark, rows):
    df = spark.createDataFrame([(*r, "m", "c") for r in rows], "conv_id long, turn long, role string, text string, mark string, cell string")
    repairs = cr.repair(df)
    out = {}
    for r in cr.repaired(df, repairs).collect():
        out.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    for conv, made in out.items():
        assert [m[0] for m in made] == list(range(len(made)))
    return {r[0]: (tuple(r)[1:], [m[1:] for m in out.get(r[0], [])]) for r in repairs.collect()}


def test_conversations_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for conv in [None, *range(120)]:
        for _ in range(rng.randint(1, 14)):
            rows.append((conv, rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"]),
                         rng.choice(["Yes.", "no", "Why?  ", " \n", None, "", "ok! ", "long " * 30 + "."])))
    rows += rows[:40]
    rng.shuffle(rows)
    found = spark_repair(spark, rows)
    convs = {r[0] for r in rows}
    assert set(found) == convs
    for conv in convs:
        assert found[conv] == brute([r[1:] for r in rows if r[0] == conv]), conv


def test_a_long_conversation_over_many_partitions(spark):
    rng = random.Random(5)
    rows = [(7, t // 2, rng.choice(["user", "assistant"]), f"{rng.randint(0, 900)}{rng.choice('.!? a')}") for t in range(3000)]
    rows += [(8, 0, "user", "hi."), (8, 1, "assistant", "hi.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = spark_repair(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[7] == brute([r[1:] for r in rows if r[0] == 7])
    assert found[8][0] == (0, 0, 0, 0, 0, 0, "KK")


def test_empty_table(spark):
    assert spark_repair(spark, []) == {}


def test_damage(spark):
    rows = [(c, t, "system", "A. b! c?") for c in (None, 1, 2, 3) for t in (None, *range(40))] + [(9, 1, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted(map(repr, queries.damaged(df).collect()))
    expected = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = {1: "", 2: text.replace(".", "").replace("!", "").replace("?", "")}.get(k, text)
        expected += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    from pyspark.sql import Row
    assert found == sorted(repr(Row(conv_id=c, turn=t, role=r, text=x)) for c, t, r, x in expected)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_registered_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    left = {}
    for r in queries.damaged(rows).collect():
        left.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    for r in queries.op11_conversation_repair(spark, SF_DIR).collect():
        facts, out = brute(left.get(r.conv_id, []))
        said = "\n".join(f"{role}:{text}" for role, text in out)
        assert tuple(r)[1:] == (*facts, hashlib.sha256(said.encode()).hexdigest())
