"""Conversation repair against every sequence of edits and against a plain DP; blocks, damage and odd tables."""

import random
import re
import zlib
from hashlib import sha256
from itertools import product

import pandas as pd
import pytest

from marginloom.llm import conversation_repair as cr

ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"
ROLES = ["system", "user", "assistant", "tool", "", None]
TEXTS = ["a.", "b!", "cut", " ", "", None, "d?\n", "é", "a."]


def faults(rows):
    seen, out = set(), []
    for _turn, role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def ordered(rows):
    """(turn, role, text) in the order of the operator, nulls as one space."""
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(r[2].encode()).hexdigest()))


def options(row, fault):
    """Edits of one row: initial, cost, what stands after it."""
    yield "D", 2, []
    if fault not in ("blank", "duplicate"):
        more = 5 * (fault == "truncated")
        yield "K", more, [(row[1], row[2])]
        for role in ("user", "assistant"):
            yield "R", 1 + more, [(role, row[2])]


def fits(lines):
    """Whether the initials are an optional s and then pairs of u and a; an empty role has none, and doesn't fit."""
    initials = [role[:1] for role, _ in lines]
    return all(initials) and re.fullmatch("(s?(ua)+)?", "".join(initials)) is not None


def every_way(rows):
    """Least (cost, audit, lines) of all edits with up to three insertions in each gap."""
    kinds = faults(rows)
    gaps = [g for n in range(4) for g in product(("user", "assistant"), repeat=n)]
    best = None

    def go(at, cost, audit, lines):
        nonlocal best
        initials = "".join(role[:1] for role, _ in lines)
        if best and (cost, audit) > best[:2] or not re.fullmatch("s?(ua)*u?", initials) or not all(r for r, _ in lines):
            return
        for gap in gaps:
            now = lines + [(role, "") for role in gap]
            spent, said = cost + 5 * len(gap), audit + "I" * len(gap)
            if at == len(rows):
                if fits(now) and (best is None or (spent, said) < best[:2]):
                    best = (spent, said, now)
            elif best is None or spent <= best[0]:
                for edit, more, kept in options(rows[at], kinds[at]):
                    go(at + 1, spent + more, said + edit, now + kept)

    go(0, 0, "", [])
    return best


def plain_dp(rows):
    """The same by the best prefix for each state, a row at a time."""
    best = {"": (0, "", [])}
    follow = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def insert(best):
        while True:
            more = {}
            for state, (cost, audit, lines) in best.items():
                role = follow[state]
                new = (cost + 5, audit + "I", lines + [(role, "")])
                if role[0] not in best or new[:2] < best[role[0]][:2]:
                    if role[0] not in more or new[:2] < more[role[0]][:2]:
                        more[role[0]] = new
            if not more:
                return best
            best = best | more

    for row, fault in zip(rows, faults(rows), strict=True):
        now = {}
        for state, (cost, audit, lines) in insert(best).items():
            for edit, more, kept in options(row, fault):
                after = kept[0][0][:1] if kept else state
                if kept and not ((after == "s" and state == "") or (after in ("u", "a") and after == follow[state][0])):
                    continue
                new = (cost + more, audit + edit, lines + kept)
                if after not in now or new[:2] < now[after][:2]:
                    now[after] = new
        best = now
    return min((v for s, v in insert(best).items() if s in ("", "a")), key=lambda v: v[:2])


def expected(rows, way=plain_dp):
    rows = ordered(rows)
    cost, audit, lines = way(rows)
    kinds, initials = faults(rows), [r[1][:1] for r in rows]
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum((a + b) not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    text = "\n".join(f"{role}:{text}" for role, text in lines)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": illegal,
        "cost": cost,
        "audit": audit,
        "repaired_sha256": sha256(text.encode()).hexdigest(),
    }


def repaired(table, **options):
    reports, messages = cr.repair_conversations(table, **options)
    digests = {r.conv_id: r.repaired_sha256 for r in cr.text_digests(messages).collect()}
    found = {r.conv_id: r.asDict() for r in reports.collect()}
    for conv, report in found.items():
        assert report.pop("conv_id") == conv
        report["repaired_sha256"] = digests.get(conv, sha256(b"").hexdigest())
    return found


def some(rng, n, roles=ROLES, texts=TEXTS):
    return [(rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_every_way_and_plain_dp_agree():
    rng = random.Random(5)
    for _ in range(60):
        rows = ordered(some(rng, rng.randint(0, 4)))
        assert every_way(rows)[:2] == plain_dp(rows)[:2]


@pytest.mark.parametrize("block_rows", [1, 3, 8192])
def test_random_conversations(spark, block_rows):
    rng = random.Random(block_rows)
    convs = {c: some(rng, rng.randint(1, 12)) for c in [None, *range(60)]}
    convs[100] = [(t, "user", "same") for t in range(40)] + [(3, "assistant", "x.")] * 5
    convs[101] = [(t, "uasu"[t % 4], f"t{t}" + ".!?x"[t % 4]) for t in range(50)]
    convs[102] = [(1, "user", " ")] * 7
    table = spark.createDataFrame([(c, *r) for c, rows in convs.items() for r in rows], ROWS)
    table = table.selectExpr("*", "1 AS text2", "'x' AS digest", "2 AS n", "3 AS block", "4 AS number")
    found = repaired(table, block_rows=block_rows)
    assert found == {c: expected(rows) for c, rows in convs.items()}


def test_messages_are_numbered(spark):
    rows = [(1, 0, "assistant", "b."), (1, 1, "user", "a."), (1, 2, "assistant", "c."), (2, 0, "tool", "x")]
    reports, messages = cr.repair_conversations(spark.createDataFrame(rows, ROWS), block_rows=2)
    found = [tuple(r) for r in messages.orderBy("conv_id", "place").collect()]
    assert {r.conv_id: r.audit for r in reports.collect()} == {1: "DKK", 2: "D"}
    assert found == [(1, 0, "K", "user", "a."), (1, 1, "K", "assistant", "c.")]


def test_runs_advance_by_powers_as_by_single_rows():
    rng = random.Random(9)
    for code in range(16):
        after = cr._split(tuple(rng.randint(0, 12) for _ in range(4)))
        slow = after
        for n in range(1, 40):
            slow = cr.costs_before(code, 1, slow)
            assert cr.costs_before(code, n, after) == slow


def test_long_conversation(spark):
    rng = random.Random(2)
    rows = [(t, rng.choice(ROLES[:3]), f"{rng.randint(0, 400)}{rng.choice('.!x')}") for t in range(3000)]
    found = repaired(spark.createDataFrame([(7, *r) for r in rows], ROWS), block_rows=100)
    assert found == {7: expected(rows)}


def test_empty_table_and_long_text(spark):
    reports, messages = cr.repair_conversations(spark.createDataFrame([], ROWS))
    assert (reports.count(), messages.count(), cr.text_digests(messages).count()) == (0, 0, 0)
    assert cr.damage_and_repair(spark.createDataFrame([], ROWS)).count() == 0
    rows = [(0, "user", "x " * 200_000 + "." + " \n" * 100_000), (1, "assistant", "y " * 200_000)]
    assert repaired(spark.createDataFrame([(1, *r) for r in rows], ROWS)) == {1: expected(rows)}


def hurt(rows):
    """The contract's damage, row by row."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if drawn == 4 else role
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        own += [(turn, role, text)] * (0 if drawn == 0 else 2 if drawn == 3 else 1)
    return out


def test_query(spark):
    from marginloom.llm.queries import op11_conversation_repair

    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        given = pd.read_parquet(f"{folder}/conversations.parquet")
        want = {c: expected(rows) for c, rows in hurt(given.itertuples(index=False, name=None)).items()}
        got = {r.conv_id: r.asDict() for r in op11_conversation_repair(spark, folder).collect()}
        assert all(row.pop("conv_id") == c for c, row in got.items())
        assert got == want


def test_conversation_whose_rows_are_all_dropped(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, gone, "user", "x."), (None, None, None, None), (6, 1, "user", "q."), (6, 2, "assistant", "r.")]
    got = {r.conv_id: r.asDict() for r in cr.damage_and_repair(spark.createDataFrame(rows, ROWS)).collect()}
    assert all(row.pop("conv_id") == c for c, row in got.items())
    assert got == {c: expected(own) for c, own in hurt(rows).items()}
    assert got[5] == {**dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0), "audit": "", "repaired_sha256": sha256(b"").hexdigest()}
