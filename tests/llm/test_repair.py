"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from shillingflow.llm import repair

SHAPE = re.compile(r"(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Least (cost, audit, lines) over all edits of (role, text, fault); deleting everything is always allowed."""
    best = [(4 * len(rows), "D" * len(rows), [])]

    def go(i, cost, audit, lines):
        if (cost, audit) > best[0][:2] and cost >= best[0][0]:
            return
        if i == len(rows) and SHAPE.fullmatch("".join(x[0] if x[0] in "sua" else "?" for x in lines)):
            best[0] = min(best[0], (cost, audit, lines))
        if cost + 3 <= best[0][0] and len(audit) < 2 * len(rows) + 3:
            for name in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*lines, f"{name}:"])
        if i == len(rows):
            return
        role, text, fault = rows[i]
        go(i + 1, cost + 4, audit + "D", lines)
        if fault in ("blank", "duplicate"):
            return
        extra = 3 if fault == "truncated" else 0
        go(i + 1, cost + extra, audit + "K", [*lines, f"{role}:{text}"])
        for name in ("user", "assistant"):
            go(i + 1, cost + 3 + extra, audit + "R", [*lines, f"{name}:{text}"])

    go(0, 0, "", [])
    return best[0]


def expected(conv, rows):
    """The contract's row of one conversation, from its rows before damage."""
    live = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        live += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    live.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    seen, shape = set(), []
    for _, role, text in live:
        rest = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
        seen.add((role, text))
        shape.append((role, text, fault))
    turns = [t for t, _, _ in live if t is not None]
    pairs = [(a[1][:1] or " ") + (b[1][:1] or " ") for a, b in zip(live, live[1:])]
    cost, audit, lines = brute(shape)
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == k for _, _, f in shape) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, many, most):
    r = random.Random(seed)
    texts = ["yes.", "no", "well? ", "éh!", "", " \n", None, "one. two", "ok."]
    out = []
    for conv in range(many):
        for k in range(r.randint(1, most)):
            turn = None if r.random() < 0.1 else k if r.random() < 0.8 else r.randint(0, 5)
            out.append((conv if conv else None, turn, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(texts)))
    return out


def by_conv(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


@pytest.mark.parametrize("piece", [256, 2, 1])
def test_equals_a_search_over_all_edits(spark, piece):
    rows = conversations(5, 60, 5) + [(77, t, "user", "same.") for t in range(4)] + [(78, 4, "user", "a."), (79, 6, None, None)]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'mine' AS at", "1 AS piece", "2 AS n").repartition(5)
    got = {tuple(r) for r in repair.repair(repair.damaged(df), piece).drop("repaired").collect()}
    assert got == {expected(c, found) for c, found in by_conv(rows).items()}


def test_pieces_give_what_the_whole_gives(spark):
    r = random.Random(8)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), r.choice(["Yes.", "No", f"Words {t}.", "", "Why?"])) for t in range(900)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(40)]
    df = repair.damaged(spark.createDataFrame(rows, ROWS))
    whole = sorted(map(tuple, repair.repair(df, 5000).drop("repaired").collect()))
    assert sorted(map(tuple, repair.repair(df, 16).drop("repaired").collect())) == whole and whole[0][6] > 300


def test_a_conversation_may_lose_all_rows_and_tables_may_be_empty(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    got = repair.op13(spark.createDataFrame([(9, gone, "user", "Hello.")], ROWS)).collect()
    assert [tuple(x) for x in got] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.op13(spark.createDataFrame([], ROWS)).collect() == []


def test_very_long_texts_and_lines(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], "long words " * 100_000 + ".") for t in range(1, 5)]
    got = repair.repair(spark.createDataFrame(rows, ROWS)).collect()[0]
    assert got["audit"] and all(len(x) > 1_000_000 for x in got["repaired"] if not x.endswith(":"))
