"""Conversation structure repair: a lightest-derivation agenda over weighted hypergraph deductions.

An item says: after the first ``i`` rows of a stretch the repaired roles end in ``state``. Its value is
(cost, audit), the cost of the edits and their initials. A deduction appends one edit, so its function
is superior (a result is never less than its antecedent) and monotone (of two values of one item
neither audit begins with the other unless it costs more, so the order survives what is appended).
Knuth's agenda therefore pops every item at its least value, and ends when the goal is popped.

A conversation longer than ``PIECE`` rows is cut into pieces. Each piece derives the lightest value
from every entry state to every exit state; deductions of two antecedents (the conversation so far,
the next piece) chain them. No task holds more than a piece's texts: a conversation may hold any share
of the table.

Edits of a row: K keep (0), R set the role to user or assistant (3), D delete (4, the only one for blank
and repeated rows); I inserts an empty user or assistant text anywhere (3). A truncated row that is not
deleted adds 3. The repaired role initials are ``(s?(ua)+)?``.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, with_running
from ..session import write_out

PIECE = 256
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ENDS = (START, ASSISTANT)
#: State after a row of this role initial, from each state that allows it.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by a user or assistant row
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
GOOD, BLANK, DUPLICATE, CUT = range(4)
WHITE = " \t\n\v\f\r"
Row = tuple[str, int]  # role initial, fault
Value = tuple[int, str]


# ---- the agenda


def lightest(rows: list[Row], entry: int, goals: tuple[int, ...] | None) -> dict[int, Value]:
    """Lightest (cost, audit) by exit state, from one entry state. With ``goals`` the agenda stops at the
    first of these exits, else when all exits are final. Rows may be inserted before each row; after the
    last one only where ``goals`` are given, since the next piece inserts before its first row."""
    n = len(rows)
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
    final: set[tuple[int, int]] = set()
    out: dict[int, Value] = {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n:
            if goals is None:
                out[state] = (cost, audit)
                continue
            if state in goals:
                return {state: (cost, audit)}
        after = NEXT[state]
        heapq.heappush(agenda, (cost + INSERT, audit + "I", i, after))
        if i == n:
            continue
        initial, fault = rows[i]
        heapq.heappush(agenda, (cost + DELETE, audit + "D", i + 1, state))
        if fault in (BLANK, DUPLICATE):
            continue
        extra = TRUNCATED if fault == CUT else 0
        kept = AFTER.get(initial, {}).get(state)
        if kept is not None:
            heapq.heappush(agenda, (cost + KEEP + extra, audit + "K", i + 1, kept))
        heapq.heappush(agenda, (cost + REROLE + extra, audit + "R", i + 1, after))
    return out


def applied(rows: list[tuple[str, str]], audit: str, state: int) -> list[str]:
    """``role:text`` of the repaired rows: what the edits make of (role, text) from a state on."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            out.append(f"{NAMES[state]}:")
            continue
        role, text = rows[i]
        i += 1
        if edit == "K":
            state = AFTER[role[0]][state]
            out.append(f"{role}:{text}")
        elif edit == "R":
            state = NEXT[state]
            out.append(f"{NAMES[state]}:{text}")
    return out


class Chain:
    """The conversation so far, by state, with pieces chained to it. What all states' audits begin with
    alike is set down once, so comparing ties reads only what they differ in."""

    def __init__(self) -> None:
        self.value: dict[int, Value] = {START: (0, "")}
        self.told: list[str] = []
        self.steps: list[dict[int, int]] = []

    def add(self, pairs: dict[tuple[int, int], Value]) -> None:
        best: dict[int, tuple[int, str, int]] = {}
        for (entry, exit_), (cost, audit) in pairs.items():
            if entry in self.value:
                had, before = self.value[entry]
                found = (had + cost, before + audit, entry)
                if exit_ not in best or found < best[exit_]:
                    best[exit_] = found
        # the assistant state allows all that these two do but a system row, which it may delete
        if ASSISTANT in best:
            for state, slack in ((START, DELETE), (SYSTEM, 0)):
                if state in best and best[state][0] > best[ASSISTANT][0] + slack:
                    del best[state]
        self.steps.append({s: e for s, (_, _, e) in best.items()})
        audits = [a for _, a, _ in best.values()]
        low, high = min(audits), max(audits)
        same_until = next((k for k, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        if same_until:
            self.told.append(low[:same_until])
        self.value = {s: (c, a[same_until:]) for s, (c, a, _) in best.items()}

    def end(self) -> tuple[int, str, list[tuple[int, int]]]:
        """Cost and audit of the whole, and the (entry, exit) state of each piece. ``add`` the last piece first,
        closed by ``closing``."""
        cost, audit, state = min((c, a, s) for s, (c, a) in self.value.items() if s in ENDS)
        path = []
        for step in reversed(self.steps):
            path.append((step[state], state))
            state = step[state]
        return cost, "".join(self.told) + audit, path[::-1]


def closing() -> dict[tuple[int, int], Value]:
    """Insertions after the last row: the lightest way from each state to an end."""
    return {(s, e): v for s in range(STATES) for e, v in lightest([], s, ENDS).items()}


# ---- damage and faults


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage, and one row with a null ``text`` for each that is dropped. Damage depends
    on crc32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 0, F.lit(None)).when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _fault(text: str, seen: bool) -> int:
    rest = text.rstrip(WHITE)
    return BLANK if not rest else DUPLICATE if seen else GOOD if rest[-1] in ".!?" else CUT


class Tally:
    """Counts over the rows of a stretch, in order."""

    def __init__(self) -> None:
        self.faults = [0] * 4
        self.illegal = 0
        self.first: str | None = None
        self.last: str | None = None

    def add(self, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial


def _initial(role: str) -> str:
    return role[:1] or " "  # an empty role fits nowhere, like a null one


OUT = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
       ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("repaired", pa.list_(pa.string()))]
OUT_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string, repaired array<string>")
SENT = 500  # conversations in a batch that goes back to Spark


def _batches(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*held)) or [[]] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])

    for row in rows:
        held.append(row)
        if len(held) >= SENT:
            yield flush()
            held.clear()
    yield flush()


def _stretches(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Neighbouring rows that agree in the first ``keys`` columns, over the bounds of batches."""
    at, held, begun = None, [], False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if not begun or row[:keys] != at:
                if begun:
                    yield at, held
                at, held, begun = row[:keys], [], True
            held.append(row[keys:])
    if begun:
        yield at, held


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs conversations of at most a piece, which follow each other sorted by turn."""
    def rows() -> Iterator[tuple]:
        for (conv,), found in _stretches(batches, 1):
            live = [(turn, role, text) for turn, role, text in found if text is not None]
            tally, seen, shape = Tally(), set(), []
            for _, role, text in live:
                fault = _fault(text, (role, text) in seen)
                seen.add((role, text))
                shape.append((_initial(role), fault))
                tally.add(*shape[-1])
            turns = {t for t, _, _ in live if t is not None}
            gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
            (cost, audit), = lightest(shape, START, ENDS).values()
            made = applied([(r, t) for _, r, t in live], audit, START)
            yield (conv, gaps, tally.faults[BLANK], tally.faults[DUPLICATE], tally.faults[CUT], tally.illegal, cost, audit,
                   hashlib.sha256("\n".join(made).encode()).hexdigest(), made)
    return _batches(rows(), OUT)


# ---- long conversations


PAIRS = "array<struct<entry:int,exit:int,cost:long,audit:string>>"
PIECE_DDL = f"conv_id long, piece long, blank long, duplicate long, truncated long, illegal long, first string, last string, pairs {PAIRS}"
PIECE_OUT = [("conv_id", pa.int64()), ("piece", pa.int64()), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")],
             ("first", pa.string()), ("last", pa.string()),
             ("pairs", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lightest value of every (entry, exit) state of each piece, and its counts."""
    def rows() -> Iterator[tuple]:
        for (conv, piece), found in _stretches(batches, 2):
            tally, shape = Tally(), []
            for _, role, text, repeated in found:
                shape.append((_initial(role), _fault(text, repeated)))
                tally.add(*shape[-1])
            pairs = [{"entry": s, "exit": e, "cost": c, "audit": a} for s in range(STATES) for e, (c, a) in lightest(shape, s, None).items()]
            yield (conv, piece, *(tally.faults[k] for k in (BLANK, DUPLICATE, CUT)), tally.illegal, tally.first, tally.last, pairs)
    return _batches(rows(), PIECE_OUT)


CHAIN_DDL = "conv_id long, piece long, entry int, audit string, blank long, duplicate long, truncated long, illegal long, cost long, tail int"
CHAIN_OUT = [("conv_id", pa.int64()), ("piece", pa.int64()), ("entry", pa.int32()), ("audit", pa.string()),
             *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")], ("tail", pa.int32())]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece with its entry state, and one without piece for the whole conversation. ``tail``
    is the state before what the last edits insert."""
    end = closing()

    def rows() -> Iterator[tuple]:
        for conv, found in _runs(batches):
            chain, sums, last, pieces = Chain(), [0] * 4, None, []
            for piece, *counts, first, final, pairs in found:
                sums = [a + b for a, b in zip(sums, counts)]
                sums[3] += last is not None and last + first not in LEGAL
                last = final
                chain.add({(p["entry"], p["exit"]): (p["cost"], p["audit"]) for p in pairs})
                pieces.append(piece)
            chain.add(end)
            cost, audit, path = chain.end()
            for piece, (entry, exit_) in zip(pieces, path):
                yield (conv, piece, entry, str(exit_), None, None, None, None, None, None)
            yield (conv, None, None, audit, *sums, cost, path[-1][0])
    return _batches(rows(), CHAIN_OUT)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Conversations with a lazy run of their pieces: only one batch of pieces is held at a time."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    ahead = next(rows, None)

    def run(conv) -> Iterator[tuple]:
        nonlocal ahead
        while ahead is not None and ahead[0] == conv:
            yield ahead[1:]
            ahead = next(rows, None)

    while ahead is not None:
        conv = ahead[0]
        yield conv, run(conv)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired text of each piece."""
    def rows() -> Iterator[tuple]:
        for (conv, piece, entry, audit), found in _stretches(batches, 4):
            yield conv, piece, applied([(role, text) for _, role, text in found], audit, entry)
    return _batches(rows(), [("conv_id", pa.int64()), ("piece", pa.int64()), ("made", pa.list_(pa.string()))])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation: one hasher reads its pieces in order and holds none of them."""
    def rows() -> Iterator[tuple]:
        for conv, found in _runs(batches):
            h, begun = hashlib.sha256(), False
            for _, made in found:
                for line in made:
                    h.update(b"\n" if begun else b"")
                    h.update(line.encode())
                    begun = True
            yield conv, h.hexdigest()
    return _batches(rows(), [("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _sorted(df: DataFrame, deal: list[str], order: list[str]) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), *deal).sortWithinPartitions(*deal, *order)


def _met(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A null-safe join on the keys; the result has the left side's."""
    right = right.withColumnsRenamed({k: f"other_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"other_{k}"))
    return left.join(right, cond, how).drop(*[f"other_{k}" for k in keys])


def _long(live: DataFrame, piece: int) -> DataFrame:
    """Conversations of more than a piece: ``conv_id`` with counts, audit and digest."""
    keyed = live.withColumn("digest", F.sha2(F.concat_ws(":", F.sha2("role", 256), F.sha2("text", 256)), 256))
    placed = with_running(keyed, ["conv_id"], ["turn", "role", "text"], None, "at")
    firsts = placed.groupBy("conv_id", "digest").agg(F.min("at").alias("first_at"))
    # the rows of one repeated text may be most of a conversation: the join's other side is one row for it
    told = _met(placed, firsts, ["conv_id", "digest"]).select(
        "conv_id", F.floor(F.col("at") / piece).alias("piece"), "at", "role", "text", (F.col("at") > F.col("first_at")).alias("repeated"))
    told = write_out(told, "repair-rows")
    pieces = _sorted(told, ["conv_id", "piece"], ["at"]).select("conv_id", "piece", "at", "role", "text", "repeated").mapInArrow(_pieces, PIECE_DDL)
    pieces = write_out(pieces, "repair-pieces")
    chained = write_out(_sorted(pieces, ["conv_id"], ["piece"]).mapInArrow(_chained, CHAIN_DDL), "repair-chains")
    chosen = chained.filter("piece is not null").select("conv_id", "piece", "entry", F.col("audit").cast("int").alias("exit"))
    ways = pieces.select("conv_id", "piece", F.explode("pairs").alias("p")).select("conv_id", "piece", "p.*")
    chosen = _met(chosen, ways, ["conv_id", "piece", "entry", "exit"])
    rows = _met(told, chosen, ["conv_id", "piece"])
    made = _sorted(rows, ["conv_id", "piece"], ["at"]).select("conv_id", "piece", "entry", "audit", "at", "role", "text").mapInArrow(
        _segments, "conv_id long, piece long, made array<string>")
    totals = chained.filter("piece is null")
    tail = totals.filter("tail in (1, 2)").select("conv_id", F.lit(None).cast("long").alias("piece"), F.when(
        F.col("tail") == SYSTEM, F.array(F.lit("user:"), F.lit("assistant:"))).otherwise(F.array(F.lit("assistant:"))).alias("made"))
    made = write_out(made.unionByName(tail), "repair-segments")
    digests = made.repartition(partitions(made.sparkSession), "conv_id").sortWithinPartitions("conv_id", F.col("piece").asc_nulls_last()).mapInArrow(
        _digests, "conv_id long, repaired_sha256 string")
    turns = live.groupBy("conv_id").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("kinds"))
    return _met(_met(totals, digests, ["conv_id"]), turns, ["conv_id"]).select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("kinds"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Per conversation ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``
    and ``repaired``, its lines (null for conversations of more than ``piece`` rows, whose lines only run
    through a hasher).

    ``rows`` has ``conv_id, turn, role, text``, a null ``text`` marking a row that only names its
    conversation. Rows are read by turn (nulls first), ties by role and text; rows without ``conv_id`` are
    one conversation. A role other than system, user or assistant by its initial, an empty one too, can
    only be set anew or deleted. A conversation without rows has zeros and empty strings. Ties of cost go
    to the ASCII-least audit. Repeated rows are repeated turns. Other columns are left out.
    """
    rows = write_out(rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"), "repair-input")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > piece).select("conv_id")
    long_ids = write_out(sizes, "repair-long")
    if long_ids.isEmpty():
        short, longer = rows, None
    else:
        short = _met(rows, long_ids, ["conv_id"], "left_anti")
        longer = _met(rows, long_ids, ["conv_id"], "left_semi")
    out = _sorted(short, ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "role", "text").mapInArrow(_whole, OUT_DDL)
    if longer is None:
        return out
    live = write_out(longer.filter("text is not null"), "repair-live")
    done = _long(live, piece).withColumn("repaired", F.lit(None).cast("array<string>"))
    empty = _met(long_ids, done.select("conv_id"), ["conv_id"], "left_anti")
    zero = F.lit(0).cast("long")
    empty = empty.select("conv_id", *[zero.alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                         F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"), F.lit(None).cast("array<string>").alias("repaired"))
    return out.unionByName(done).unionByName(empty)


def op13(rows: DataFrame) -> DataFrame:
    return repair(damaged(rows)).drop("repaired")
