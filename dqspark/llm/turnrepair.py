"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation's role initials read ``(s?(ua)+)?``, which a machine of
four states accepts.  Rows are kept, given another role or deleted, and empty
turns are inserted, at least cost.  Forward and backward cost vectors of the
four states meet in the middle of a conversation; of the states with the least
sum the one whose edits so far come first in ASCII order is the crossing, and
both halves are solved in the same way.  Only vectors are held, never a table
of all rows and states.

Conversations are sorted by range, so one that is longer than a task's share
lies in several pieces.  A piece is summed up as a matrix of costs from state to
state; the pieces' crossings are chosen over these matrices, by the same
procedure, and each piece is then solved by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from .common import F, keep, only, small_batches, sql_type

PIECE_ROWS = 20_000
PIECE_BYTES = 8_000_000
OUT_BYTES = 4_000_000
NEVER = 1 << 60

# Edits and costs, white space, ends of sentences.
#   K keep 0, R give another role 3, D delete 4, I insert an empty turn 3; an undeleted truncated row 3
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = {"u": "user", "a": "assistant"}

# States: nothing yet, behind s, behind u, behind a.  The state that each initial leads to.
_NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_CLOSING = ["", "II", "I", ""]  # inserts that end a conversation
CLEAN, CUT, GONE = range(3)  # a row that may stay, a truncated one, one that must go

Step = Sequence[Sequence[tuple[int, int, object]]]  # by state: (state behind, cost, order among these edits)


def _wanted(state: int) -> str:
    """The role that an insert, or a row that gets another role, has in a state."""
    return "a" if state == 2 else "u"


@lru_cache(maxsize=None)
def step(initial: str, fault: int) -> Step:
    """What one row can do: from each state the cheapest edits to each other one, inserts
    in front of the row first, of equal costs the least in ASCII order."""
    out = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        at, inserts = state, ""
        for _ in range(4):
            paid = INSERT * len(inserts)
            moves = [(at, paid + DELETE, inserts + "D")]
            if fault != GONE:
                stay = paid + (TRUNCATED if fault == CUT else 0)
                moves.append((_NEXT[at][_wanted(at)], stay + REROLE, inserts + "R"))
                if initial in _NEXT[at]:
                    moves.append((_NEXT[at][initial], stay + KEEP, inserts + "K"))
            for to, cost, edits in moves:
                best[to] = min(best.get(to, (NEVER, "")), (cost, edits))
            at, inserts = _NEXT[at][_wanted(at)], inserts + "I"
        out.append(tuple((to, cost, edits) for to, (cost, edits) in sorted(best.items())))
    return tuple(out)


def forward(steps: Sequence[Step], lo: int, hi: int, entry: int) -> tuple[list[int], list[int]]:
    """For each state behind the steps the least cost from ``entry``, and its place in
    the ASCII order of the cheapest edits to the four states.

    No such string is the beginning of another, as each ends with a row's own
    edit; so the order of two is known from the order before the step, or from
    the step's edits alone.
    """
    cost, rank = [NEVER] * 4, [0] * 4
    cost[entry] = 0
    for i in range(lo, hi):
        found: list[tuple | None] = [None] * 4
        for state in range(4):
            if cost[state] < NEVER:
                for to, c, order in steps[i][state]:
                    new = (cost[state] + c, rank[state], order)
                    if found[to] is None or new < found[to]:
                        found[to] = new
        ranks = sorted((x[1:], to) for to, x in enumerate(found) if x is not None)
        for place, (_, to) in enumerate(ranks):
            rank[to] = place
        cost = [NEVER if x is None else x[0] for x in found]
    return cost, rank


def backward(steps: Sequence[Step], lo: int, hi: int, goal: int) -> list[int]:
    """For each state in front of the steps the least cost to ``goal`` behind them."""
    cost = [NEVER] * 4
    cost[goal] = 0
    for i in range(hi - 1, lo - 1, -1):
        cost = [min([c + cost[to] for to, c, _ in steps[i][state]], default=NEVER) for state in range(4)]
    return cost


def crossings(steps: Sequence[Step], lo: int, hi: int, entry: int, goal: int) -> list[int]:
    """The state behind each step on the audit-least of the cheapest ways."""
    if hi - lo <= 1:
        return [goal] * (hi - lo)
    mid = (lo + hi) // 2
    ahead, rank = forward(steps, lo, mid, entry)
    back = backward(steps, mid, hi, goal)
    cross = min((ahead[q] + back[q], rank[q], q) for q in range(4) if ahead[q] < NEVER)[2]
    return crossings(steps, lo, mid, entry, cross) + crossings(steps, mid, hi, cross, goal)


def goal_of(cost: list[int], rank: list[int]) -> int:
    """The state at the end of the cheapest way, with the inserts that close it."""
    return min((cost[q] + INSERT * len(_CLOSING[q]), rank[q], q) for q in range(4) if cost[q] < NEVER)[2]


def repair_rows(rows: list[tuple[str, str]], steps: Sequence[Step], entry: int, goal: int, closing: str) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, audit and repaired (role, text) of rows between two states."""
    cost, audit, out, state = 0, [], [], entry
    for row, one, to in zip([*rows, None], [*steps, None], [*crossings(steps, 0, len(steps), entry, goal), None]):
        edits = closing
        if row is not None:
            c, edits = next((c, edits) for t, c, edits in one[state] if t == to)
            cost += c
        else:
            cost += INSERT * len(closing)
        audit.append(edits)
        for e in edits:
            role = _wanted(state)
            if e == "I":
                out.append((ROLES[role], ""))
            elif e == "R":
                out.append((ROLES[role], row[1]))
            elif e == "K":
                role = row[0][:1]
                out.append(row)
            if e != "D":
                state = _NEXT[state][role]
    return cost, "".join(audit), out


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


class _Piece:
    """Rows of one conversation, in order, with what is counted of them."""

    def __init__(self, rows: list[dict], first: set[int] | None = None):
        """``first``: places of rows that are the first of their role and text (None: told here)."""
        rows = [r for r in rows if r["present"]]
        self.rows = [(r["role"], r["text"]) for r in rows]
        self.turns = [r["turn"] for r in rows if r["turn"] is not None]
        self.counts = [0, 0, 0]  # blank, duplicate, truncated
        self.steps: list[Step] = []
        seen: set[bytes] = set()
        for i, (role, text) in enumerate(self.rows):
            end = text.strip(SPACE)[-1:]
            again = False
            if end:
                if first is None:
                    d = _digest(role, text)
                    again = d in seen
                    seen.add(d)
                else:
                    again = i not in first
            kind = 0 if not end else 1 if again else 2 if end not in ENDS else None
            if kind is not None:
                self.counts[kind] += 1
            self.steps.append(step(role[:1], CLEAN if kind is None else CUT if kind == 2 else GONE))
        self.initials = [role[:1] for role, _ in self.rows]
        self.illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(self.initials, self.initials[1:]))

    def turn_facts(self) -> dict:
        distinct = sum(a != b for a, b in zip(self.turns, self.turns[1:])) + bool(self.turns)
        return {"min_turn": self.turns[0] if self.turns else None, "max_turn": self.turns[-1] if self.turns else None, "distinct_turns": distinct}

    def solved(self, conv_id, piece: int, pieces: int, entry: int, goal: int, closing: str, more_illegal: int = 0, same_turn: int = 0) -> dict:
        cost, audit, out = repair_rows(self.rows, self.steps, entry, goal, closing)
        facts = self.turn_facts()
        facts["distinct_turns"] -= same_turn
        counts = dict(zip(("blank", "duplicate", "truncated"), self.counts))
        turns = [{"role": r, "text": t} for r, t in out]
        return {"conv_id": conv_id, "piece": piece, "pieces": pieces, **facts, **counts, "illegal": self.illegal + more_illegal, "cost": cost, "audit": audit, "turns": turns}


def _weight(rows: list[dict]) -> int:
    return sum(64 + len(r["text"]) for r in rows)


_ROW = "array<struct<turn:{turn},role:string,text:string,present:boolean>>"
_SOLVED = "conv_id {conv}, piece bigint, pieces int, min_turn {turn}, max_turn {turn}, distinct_turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, turns array<struct<role:string,text:string>>"


def _arrow(names: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(names))


def _emit(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few MB."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 200 + sum(len(t["text"]) for t in r.get("rows") or r.get("turns") or [])
        if size >= OUT_BYTES or len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None, null_as: str = " ", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired conversations: a row for each piece of a conversation, nearly
    always one (``piece`` orders them, ``pieces`` is their number), with

    * turns: the repaired (role, text), and audit: the edits' initials in order;
    * cost, blank, duplicate, truncated, illegal: counts of the rows as they came;
    * min_turn, max_turn, distinct_turns: of the turns that aren't null, each
      counted in the first piece that has it.

    Rows are taken by turn (nulls first), ties by role, then by the text's MD5;
    repeated rows are duplicates of the first.  A null role or text counts as
    ``null_as``; null ids are one conversation.  Rows for which ``present`` isn't
    true count for nothing, but their conversation is listed: one without any
    row has no turns and an empty audit.  An empty table gives an empty result;
    other columns are not read.  A piece ends at ``piece_rows`` rows or
    ``PIECE_BYTES`` of text, and where a task's range ends; the repair is the
    same however conversations are cut.
    """
    spark = rows.sparkSession
    kept = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    src = rows.select(
        *[rows[f"`{c}`"].alias(n) for c, n in ((id_col, "conv_id"), (turn_col, "turn"))],
        *[F.coalesce(rows[f"`{c}`"].cast("string"), F.lit(null_as)).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
        kept.alias("present"),
    )
    conv, turn = sql_type(src, "conv_id"), sql_type(src, "turn")
    # ranges cut anywhere, even between repeated rows: they are told apart by a salt
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(64)).cast("int")
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "mark", "salt"]
    dealt = src.withColumn("mark", F.md5("text")).withColumn("salt", salt).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", "turn", "role", "text", "present")

    solved_schema = _SOLVED.format(conv=conv, turn=turn)
    first_schema = f"{solved_schema}, open boolean, rows {_ROW.format(turn=turn)}"
    first_arrow, solved_arrow = _arrow(first_schema, spark), _arrow(solved_schema, spark)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations that lie within the task's range are solved; pieces of the first
        and the last one, and of long ones, are left open."""

        def pieces() -> Iterator[dict]:
            number = TaskContext.get().partitionId() << 32
            held: list[dict] = []
            size = 0
            edge = True  # the range's first conversation, or one that is already in pieces

            def left_open() -> dict:
                nonlocal number
                number += 1
                return {"conv_id": held[0]["conv_id"], "piece": number, "open": True, "rows": [{k: r[k] for k in ("turn", "role", "text", "present")} for r in held]}

            for b in small_batches(batches):
                for r in b.to_pylist():
                    if held and r["conv_id"] != held[0]["conv_id"]:
                        if edge:
                            yield left_open()
                        else:
                            number += 1
                            p = _Piece(held)
                            goal = goal_of(*forward(p.steps, 0, len(p.steps), 0))
                            yield {**p.solved(held[0]["conv_id"], number, 1, 0, goal, _CLOSING[goal]), "open": False}
                        held, size, edge = [], 0, False
                    elif held and (len(held) >= piece_rows or size >= PIECE_BYTES):
                        yield left_open()
                        held, size, edge = [], 0, True
                    held.append(r)
                    size += 64 + len(r["text"])
            if held:
                yield left_open()

        yield from _emit(pieces(), first_arrow)

    found = keep(dealt.mapInArrow(whole, first_schema), "turns-first")
    done = found.filter(~F.col("open")).drop("open", "rows")
    open_ = found.filter("open").select("conv_id", "piece", "rows")
    return done.unionByName(_joined(open_, conv, turn, solved_schema, solved_arrow))


def _joined(open_: DataFrame, conv: str, turn: str, solved_schema: str, solved_arrow: pa.Schema) -> DataFrame:
    """The open pieces, solved by the crossings between them."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            rows = [r for r in b.column(2)[0].as_py() if r["present"]]
            found = [(i, _digest(r["role"], r["text"])) for i, r in enumerate(rows) if r["text"].strip(SPACE)]
            at = pa.array([0] * len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array([i for i, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())], names=["conv_id", "piece", "at", "digest"])

    # the first row of each role and text: at most as many as a piece has rows
    told = open_.mapInArrow(digests, f"conv_id {conv}, piece bigint, at int, digest binary").groupBy("conv_id", "digest").agg(F.min(F.struct("piece", "at")).alias("first"))
    firsts = told.select("first.*").groupBy("piece").agg(F.collect_list("at").alias("firsts"))
    rows = keep(open_.join(firsts, "piece", "left").select("conv_id", "piece", "rows", "firsts"), "turns-open")

    facts = f"conv_id {conv}, piece bigint, costs array<bigint>, ranks array<int>, first_initial string, last_initial string, min_turn {turn}, max_turn {turn}"
    facts_arrow = _arrow(facts, open_.sparkSession)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for b in small_batches(batches, 1):
                (r,) = b.to_pylist()
                p = _Piece(r["rows"], set(r["firsts"] or ()))
                ways = [forward(p.steps, 0, len(p.steps), q) for q in range(4)]
                t = p.turn_facts()
                ends = {"first_initial": p.initials[0] if p.rows else None, "last_initial": p.initials[-1] if p.rows else None}
                yield {"conv_id": r["conv_id"], "piece": r["piece"], "costs": [c for w in ways for c in w[0]], "ranks": [k for w in ways for k in w[1]], **ends, "min_turn": t["min_turn"], "max_turn": t["max_turn"]}

        yield from _emit(each(), facts_arrow)

    def cross(pdf: pd.DataFrame) -> pd.DataFrame:
        """One conversation's pieces: the states between them, and what lies across a cut."""
        pdf = pdf.sort_values("piece")
        steps = []
        for costs, ranks in zip(pdf["costs"], pdf["ranks"]):
            steps.append([[(to, int(costs[4 * q + to]), int(ranks[4 * q + to])) for to in range(4) if costs[4 * q + to] < NEVER] for q in range(4)])
        n = len(steps)
        goal = goal_of(*forward(steps, 0, n, 0))
        behind = crossings(steps, 0, n, 0, goal)
        out = pd.DataFrame({"piece": pdf["piece"].to_numpy(), "pieces": n, "entry": [0, *behind[:-1]], "goal": behind, "closing": [""] * (n - 1) + [_CLOSING[goal]]})
        illegal, same, before, last = [], [], None, None
        for a, z, low, high in zip(pdf["first_initial"], pdf["last_initial"], pdf["min_turn"], pdf["max_turn"]):
            some = isinstance(a, str)
            illegal.append(int(some and before is not None and before + a not in ("su", "ua", "au")))
            same.append(int(not pd.isna(low) and last is not None and last == low))
            before, last = z if some else before, last if pd.isna(high) else high
        return out.assign(more_illegal=illegal, same_turn=same)

    met = rows.mapInArrow(summed, facts).groupBy("conv_id").applyInPandas(cross, "piece bigint, pieces int, entry int, goal int, closing string, more_illegal int, same_turn int")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for b in small_batches(batches, 1):
                (r,) = b.to_pylist()
                p = _Piece(r["rows"], set(r["firsts"] or ()))
                yield p.solved(r["conv_id"], *[r[c] for c in ("piece", "pieces", "entry", "goal", "closing", "more_illegal", "same_turn")])

        yield from _emit(each(), solved_arrow)

    # piece numbers are unique, so this join deals long conversations out evenly
    return rows.join(keep(met, "turns-crossings"), "piece").mapInArrow(solve, solved_schema)


def digests(pieces: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of repaired conversations, one row each.

    The hash is over ``role:text``, joined by newlines.  SHA-256 can only be
    computed in order: a conversation in several pieces is hashed by one task,
    through which its pieces stream one at a time.
    """
    kind = sql_type(pieces, "conv_id")
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("distinct_turns"), F.lit(0)).cast("long").alias("gaps")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    one = pieces.filter("pieces = 1").select("conv_id", gaps, *counts, "audit", F.sha2(text, 256).alias("repaired_sha256"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out, h, empty = [], [], None, True
        kinds = None

        for b in small_batches(batches, 1):
            kinds = b.schema.field(0).type
            (r,) = b.to_pylist()
            if h is None or ids[-1] != r["conv_id"]:
                if h is not None:
                    out.append(h.hexdigest())
                ids.append(r["conv_id"])
                h, empty = hashlib.sha256(), True
            for t in r["turns"]:
                h.update(("" if empty else "\n").encode() + f"{t['role']}:{t['text']}".encode())
                empty = False
        if h is not None:
            out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, kinds), pa.array(out, pa.string())], names=["conv_id", "repaired_sha256"])

    many = pieces.filter("pieces > 1")
    sha = many.select("conv_id", "piece", "turns").repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(hashed, f"conv_id {kind}, repaired_sha256 string")
    summed = many.groupBy("conv_id").agg(
        F.min("min_turn").alias("min_turn"), F.max("max_turn").alias("max_turn"), F.sum("distinct_turns").alias("distinct_turns"), *[F.sum(c).alias(c) for c in counts],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda p: p["audit"]), "").alias("audit"),
    )
    sha = sha.withColumnRenamed("conv_id", "hashed_id")
    long = summed.join(sha, F.col("conv_id").eqNullSafe(F.col("hashed_id"))).select("conv_id", gaps, *counts, "audit", "repaired_sha256")
    return one.unionByName(long)


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, present): conversations with faults, by
    crc32 of ``conv_id:turn`` modulo 20: 0 a row is gone (not ``present``), 1 its
    text is empty, 2 its text has no ``.!?``, 3 it stands twice, 4 its role is
    user.  Nulls in role and text, and in what is hashed, are one space."""
    src = only(rows, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("way") == 1, F.lit("")).when(F.col("way") == 2, F.translate(part("text"), ENDS, "")).otherwise(part("text"))
    role = F.when(F.col("way") == 4, F.lit("user")).otherwise(part("role"))
    out = src.withColumn("way", way).select("conv_id", "turn", role.alias("role"), text.alias("text"), "way")
    copies = F.explode(F.when(F.col("way") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return out.withColumn("copy", copies).select("conv_id", "turn", "role", "text", (F.col("way") != 0).alias("present"))
