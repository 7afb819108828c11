"""Conversation repair against all possible edits, cut into pieces, and odd rows."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from dqspark.llm import turnrepair as T

ROLES = ["system", "user", "assistant", "tool", ""]
TEXTS = ["Fine.", "Good!", "cut", " \t", "", "Why?", "end. \n"]
SCHEMA = "conv_id long, turn long, role string, text string, piece int, audit string"


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def faults(rows):
    """(initial, fault) of each row, in order."""
    out, seen = [], set()
    for _, _, role, text in rows:
        inner = text.strip(" \t\n\x0b\x0c\r")
        again = (role, text) in seen
        seen.add((role, text))
        out.append((role[:1], "blank" if not inner else "duplicate" if again else "truncated" if inner[-1] not in ".!?" else ""))
    return out


def brute(rows):
    """(cost, audit, repaired) by trying every edit of every row with up to two inserts around it."""
    best = None
    marks = faults(rows)
    choices = []
    for (initial, fault), (_, _, role, text) in zip(marks, rows):
        cut = 3 if fault == "truncated" else 0
        own = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            own += [(cut, "K", [(role, text)])] + [(3 + cut, "R", [(r, text)]) for r in ("user", "assistant")]
        choices.append(own)
    inserted = [(3 * n, "I" * n, [(r, "") for r in p]) for n in range(3) for p in itertools.product(("user", "assistant"), repeat=n)]
    for picks in itertools.product(inserted, *[[(a[0] + i[0], a[1] + i[1], a[2] + i[2]) for a in c for i in inserted] for c in choices]):
        cost, audit = sum(p[0] for p in picks), "".join(p[1] for p in picks)
        if best is not None and (cost, audit) >= best[:2]:
            continue
        turns = [t for p in picks for t in p[2]]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in turns)):
            best = (cost, audit, turns)
    return best


def expected(rows):
    rows = ordered(rows)
    cost, audit, turns = brute(rows)
    marks = faults(rows)
    t = [r[1] for r in rows if r[1] is not None]
    pairs = [a[0] + b[0] for a, b in zip(marks, marks[1:])]
    counts = [sum(f == x for _, f in marks) for x in ("blank", "duplicate", "truncated")]
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest()
    return (max(t) - min(t) + 1 - len(set(t)) if t else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_all_edits(spark):
    random.seed(7)
    convs = {c: [(c, random.choice([None, *range(4)]), random.choice(ROLES), random.choice(TEXTS)) for _ in range(random.randrange(1, 4))] for c in range(60)}
    got = {r.conv_id: tuple(r)[1:] for r in T.digests(T.repair(frame(spark, [r for c in convs.values() for r in c]))).collect()}
    assert got == {c: expected(rows) for c, rows in convs.items()}


@pytest.mark.parametrize("piece_rows", [1, 3, 50])
def test_pieces_do_not_matter(spark, piece_rows):
    random.seed(piece_rows)
    rows = [(c, random.choice([None, *range(200)]), random.choice(ROLES), f"{random.choice(TEXTS)}{random.randrange(8)}{random.choice(['', '.'])}") for c, n in ((1, 300), (2, 5), (None, 150), (3, 1)) for _ in range(n)]
    whole = T.digests(T.repair(frame(spark, rows).coalesce(1))).collect()
    pieces = T.repair(frame(spark, rows), piece_rows=piece_rows)
    assert pieces.filter("pieces > 1").count() > 0
    assert sorted(T.digests(pieces).collect(), key=repr) == sorted(whole, key=repr)
    assert [r.conv_id for r in whole].count(1) == 1 and len(whole) == 4


def test_linear_space_agrees_with_a_full_table(spark):
    """Crossings against a table of (cost, audit) of every row and state."""
    random.seed(3)
    for n in (1, 2, 7, 64, 500):
        initials = random.choices("suat", k=n)
        steps = [T.step(c, random.randrange(3)) for c in initials]
        table = {0: (0, "")}
        for s in steps:
            new = {}
            for q, (c, a) in table.items():
                for to, more, edits in s[q]:
                    new[to] = min(new.get(to, (T.NEVER, "")), (c + more, a + edits))
            table = new
        want = min((c + 3 * len(T._CLOSING[q]), a + T._CLOSING[q]) for q, (c, a) in table.items())
        goal = T.goal_of(*T.forward(steps, 0, n, 0))
        cost, audit, _ = T.repair_rows([(c, "") for c in initials], steps, 0, goal, T._CLOSING[goal])
        assert (cost, audit) == want


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, 5, "user", "Hi."), (2, 5, "user", "Hi."), (2, 5, "user", "Hi."), (3, 1, "user", "a b. " * 300_000), (3, 2, "assistant", "Yes.")]
    got = {r.conv_id: r for r in T.repair(frame(spark, rows)).collect()}
    assert (got[1].audit, got[1].blank, got[1].turns, got[1].min_turn) == ("D", 1, [], None)
    assert (got[2].audit, got[2].duplicate, got[2].cost) == ("KDDI", 2, 11)
    assert got[3].audit == "KK" and got[3].turns[0].text == "a b. " * 300_000
    assert T.repair(frame(spark, rows).limit(0)).collect() == []


def test_conversation_without_rows(spark):
    rows = frame(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "user", "Hi.")])
    got = {r.conv_id: tuple(r)[1:] for r in T.digests(T.repair(rows, present=F.col("conv_id") == 1)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[2] == (0, 0, 0, 0, 0, 0, "", empty) and got[1][6] == "KK"


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in (None, 0, 1)]
    got = {}
    for r in T.damaged(frame(spark, rows)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.present))
    ways = set()
    for c, t, role, text in rows:
        way = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        ways.add(way)
        one = ("user" if way == 4 else role, "" if way == 1 else "One Two Three" if way == 2 else text, way != 0)
        assert got[c, t] == [one] * (2 if way == 3 else 1)
    assert {0, 1, 2, 3, 4} <= ways
