import random
import re

import pytest

from shillingflow.llm import quotes

from .helpers import prose

SHAPE = "conv_id long, turn long, role string, text string"
THREAD = [
    (1, 0, "user", "How do I boil an egg?\nAnd how long?"),
    (1, 1, "assistant", "> How do I boil an egg?\nIn water.\n\n> And how  LONG?\nSix minutes."),
    (1, 2, "user", "Thanks, unrelated remark."),
    (1, 3, "user", "On Monday, A wrote:\n>> And how long?\n> Six minutes.\nThat is too long."),
    (1, 4, "assistant", "> That is\n> too long.\nFive, then."),
    (1, 5, "user", "> nobody said this\nReally."),
    (2, 0, "user", "Six minutes."),
]


def by_turn(spark, rows):
    return {(r.conv_id, r.turn): r for r in quotes.op10(spark.createDataFrame(rows, SHAPE)).collect()}


def test_a_thread(spark):
    got = by_turn(spark, THREAD)
    assert [got[1, t].reply_turn for t in range(6)] == [None, 0, None, 1, 3, None]
    assert [got[1, t].thread_turn for t in range(6)] == [0, 0, 2, 0, 0, 5]
    assert [got[1, t].depth for t in range(6)] == [0, 1, 0, 2, 3, 0]
    assert [got[1, t].position for t in range(6)] == [0, 1, 4, 2, 3, 5]
    assert [(got[1, t].n_quoted, got[1, t].n_linked) for t in range(6)] == [(0, 0), (2, 2), (0, 0), (2, 2), (1, 1), (1, 0)]
    assert got[1, 1].content == "In water.\n\nSix minutes." and got[1, 3].content == "That is too long." and got[1, 0].content == THREAD[0][3]
    assert got[1, 4].chat == "<|assistant|>\nFive, then.\n" and got[2, 0].reply_turn is None


def test_levels_of_marks(spark):
    rows = [(1, 0, "user", "deep words"), (1, 1, "user", "> > >deep words\n>>> \n>other\nmine"), (1, 2, "user", "a > b is no quote\n  > mine")]
    got = by_turn(spark, rows)
    assert got[1, 1].reply_turn == 0 and got[1, 1].n_quoted == 2 and got[1, 2].content == "a > b is no quote" and got[1, 2].reply_turn == 1


def test_long_chain_of_replies(spark):
    rows = [(7, 0, "user", "message number 0")] + [(7, i, "user", f"> message number {i - 1}\nmessage number {i}") for i in range(1, 70)]
    got = by_turn(spark, rows)
    assert [got[7, i].depth for i in range(70)] == list(range(70)) and {r.thread_turn for r in got.values()} == {0}


def test_quotes_cut_out_of_a_line_and_wrapped_anew(spark):
    rows = [(1, 0, "user", "First sentence stands here. Second sentence follows it."), (1, 1, "user", "Something else was said here, too."),
            (1, 2, "user", "> Second sentence follows it.\nYes."), (1, 3, "user", "> sentence stands here. Second\n> sentence follows\nNo."),
            (1, 4, "user", "> follows it\nShort."), (1, 5, "user", "> else was said\nThree words."), (1, 6, "user", "> stands here, second [...] said to nobody at all\nNo.")]
    got = by_turn(spark, rows)
    assert [(got[1, t].n_linked, got[1, t].reply_turn) for t in range(2, 7)] == [(1, 0), (1, 0), (0, None), (1, 1), (0, None)]


def plain_links(rows):
    """Reply of each message by looking for the words of its quotes in every earlier message, one after the other."""
    def words(text):
        return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "

    own = {(c, t): "\n".join(x for x in text.split("\n") if not x.startswith(">")) for c, t, _, text in rows}
    out = {}
    for c, t, _, text in rows:
        passages, last = [], 0
        for line in text.split("\n"):
            marks = re.match(r"^(>[> ]*)?", line).group()
            level = marks.count(">")
            if level and level == last:
                passages[-1][1] += " " + line[len(marks):]
            elif level:
                passages.append([level, line[len(marks):]])
            last = level
        linked = [(-level, next((u for u in range(t) if words(p) in words(own[c, u])), None)) for level, p in passages]
        good = [x for x in linked if x[1] is not None]
        out[c, t] = (len(passages), len(good), max(good)[1] if good else None)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force_over_generated_threads(spark, seed):
    r, rows = random.Random(seed), []
    for c in range(12):
        said = []
        for t in range(15):
            mine = "\n".join(prose(r.randrange(10**9), r.randint(12, 30)) + "." for _ in range(r.randint(1, 3)))
            text = mine
            for _ in range(r.randint(0, 2) if said else 0):
                of = r.choice(said + [prose(r.randrange(10**9), 20)]).split()  # some quote what nobody wrote
                lo = r.randrange(len(of) - 8)
                cut = of[lo:lo + r.randint(6, 25)]
                marks, at = ">" * r.randint(1, 3) + " ", r.randint(1, len(cut))
                text = "\n".join([marks + " ".join(x) for x in (cut[:at], cut[at:]) if x] + ["", text])
            said.append(mine)
            rows.append((c, t, "user", text))
    want = plain_links(rows)
    assert sum(n for _, n, _ in want.values()) > 80
    assert {k: (x.n_quoted, x.n_linked, x.reply_turn) for k, x in by_turn(spark, rows).items()} == want


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (None, 0, "user", "> x"), (1, None, "user", "> x\ny"), (1, 1, "user", ""), (1, 1, "user", ""), (2, 0, "user", ">" * 5000),
            (3, 0, "user", "word " * 50_000), (3, 1, "user", "> " + "word " * 50_000), (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 1, "user", "> same")]
    got = quotes.op10(spark.createDataFrame(rows, SHAPE)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.conv_id, []).append(r)
    assert all(sorted(x.position for x in v) == list(range(len(v))) for v in by.values())
    assert [r.reply_turn for r in by[3] if r.turn == 1] == [0] and [r.reply_turn for r in by[4] if r.turn == 1] == [0]
    assert quotes.op10(spark.createDataFrame([], SHAPE)).collect() == []


def test_other_columns_stay_and_no_python_runs(spark):
    df = spark.createDataFrame(THREAD, SHAPE).selectExpr("*", "'mine' AS number", "'mine' AS depth", "'mine' AS quoting", "'mine' AS rest")
    got = quotes.reply_ordered(df)
    assert got.columns[:7] == ["conv_id", "turn", "role", "text", "number", "quoting", "rest"]
    assert {(r.number, r.quoting, r.rest) for r in got.collect()} == {("mine",) * 3}
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
