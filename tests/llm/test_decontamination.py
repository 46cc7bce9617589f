"""Decontamination against a plain search for every window."""

import hashlib
import random
import re

import pytest

from shillingflow.llm import decontamination as d

from .helpers import no_docs, odd_docs, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w = words(text)
    hit, ids = set(), set()
    for item, body in items:
        x = words(body)
        n = min(10, len(x))
        windows = {tuple(x[k:k + n]) for k in range(len(x) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k:k + n]) in windows:
                hit.update(range(k, k + n))
                ids |= {str(item)} if item is not None else set()
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def sample(seed):
    """Documents of a small vocabulary that quote items, whole, cut, changed, at ends, one after the other."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["Éa", "x9", "日本", "Zed"]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 9, 10, 11, 40])))) for k in range(25)]
    items += [(100, items[4][1].upper()), (101, items[4][1].replace(" ", ", ")), (101, items[5][1]), (None, items[6][1]), (102, None), (103, ""), (104, "?! ...")]
    items += [(105, " ".join(f"v{k % 700}" for k in range(3000)))]
    docs = []
    for k in range(80):
        parts = []
        for _ in range(r.randint(0, 6)):
            x = (r.choice(items)[1] or "").split()
            lo = r.randint(0, max(len(x) - 1, 0))
            parts.append(" ".join(x[lo:lo + r.choice([5, 10, 12, 50])]) if r.random() < 0.7 else " ".join(r.choice(vocabulary) for _ in range(8)))
        docs.append((k, r.choice([" ", "\n-- ", "é ", "\x00"]).join(parts)))
    return docs, items


@pytest.mark.parametrize("most", [d.MOST_WORDS, 600])
def test_equals_a_plain_search(spark, most):
    docs, items = sample(3)
    assert most > 600 or len(items) > 20
    df = spark.createDataFrame(docs + docs[:3], "doc_id long, text string").selectExpr("*", "'x' AS spans", "0 AS mark", "1 AS classes")
    out = d.report(*d.find(df, spark.createDataFrame(items, ITEMS).selectExpr("*", "'y' AS class", "1 AS body"), most_words=most)).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in out)
    assert got == sorted((k, *brute(t, items)) for k, t in docs + docs[:3])
    texts = dict(docs)
    for r in out:
        for s in r["spans"]:
            assert words(texts[r["doc_id"]][s["start"]:s["end"]]) == words(texts[r["doc_id"]])[s["first"]:s["first"] + s["words"]]


def test_parts_of_a_long_text_keep_the_state(monkeypatch):
    monkeypatch.setattr(d, "PART", 16)
    patterns = d.Patterns([(b"c", b"a b c d e f g h i j")], 10)
    text = b"x " * 37 + b"a b c d e f g h i j " + b"y " * 21 + b"b c d a b c d e f g h i j k"
    n, runs, classes = patterns.scan(text)
    assert (n, runs, classes) == (len(text.split()), [(37, 47), (71, 81)], {b"c"})


def test_odd_rows(spark):
    items = [(1, odd_rows()[0][1]), (2, "few words here")]
    got = sorted(d.op12(odd_docs(spark, clash=True), spark.createDataFrame(items, ITEMS)).collect(), key=repr)
    assert sorted(map(repr, ((r[0], *brute(r[1], items)) for r in odd_rows()))) == sorted(repr(tuple(r)) for r in got)
    assert d.op12(no_docs(spark), spark.createDataFrame(items, ITEMS)).collect() == []
    assert not any(r["contaminated"] for r in d.op12(odd_docs(spark), spark.createDataFrame([], ITEMS)).collect())
    kept = {r["doc_id"] for r in d.cleaned(odd_docs(spark), spark.createDataFrame(items, ITEMS)).collect()}
    assert 1 not in kept and 7 not in kept and 9 in kept
