import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from shillingflow.llm import minhash
from shillingflow.llm.components import components

from .helpers import no_docs, odd_docs, odd_rows, prose


def groups(rows, words, percent):
    """Brute force: sets of words, all pairs, and the smallest id that links reach."""
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    low = {d: d for d in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            low[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_rows():
    rows, base = [], prose(5, 200).split()
    for i in range(60):  # copies of one text with a few other words each
        words = list(base)
        for k in range(i % 12):
            words[(7 * i + 31 * k) % 200] = f"w{i}x{k}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, prose(i, 60)) for i in range(40)]
    rows += [(200, "A b"), (201, "a B"), (202, "a"), (203, ""), (204, None), (205, "a b c")]
    return rows


@pytest.mark.parametrize("words, block", [(4, 2048), (5, 2048), (4, 8)])
def test_like_brute_force(spark, words, block):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, words, 80, block).collect()}
    assert got == groups(rows, words, 80)


@pytest.mark.parametrize("turned", [False, True])
def test_an_id_with_several_texts_links_by_each(spark, turned):
    rows = near_rows() + [(1, prose(500, 80)), (300, prose(500, 80) + " more"), (105, near_rows()[3][1]), (301, prose(7, 60) + " x"), (301, prose(8, 60)),
                          (301, prose(8, 60)), (302, None), (302, prose(501, 60)), (303, prose(501, 60)), (None, prose(501, 60)), (None, "other")]
    rows = rows[::-1] if turned else rows
    texts = {1000 + i: text for i, text in enumerate(sorted({(d, t or "") for d, t in rows if d is not None}))}
    linked = groups([(k, t) for k, (_, t) in texts.items()], 4, 80)
    low = {d: d for d, _ in rows if d is not None}
    for _ in low:  # the smallest id of a component, until nothing changes
        of = defaultdict(list)
        for k, (d, _) in texts.items():
            of[linked[k][1]].append(low[d])
        low = {d: min(min(of[linked[k][1]]) for k, (x, _) in texts.items() if x == d) for d in low}
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    assert len(got) == len(rows)
    assert all((r.component_id, r.kept) == ((low[r.doc_id], low[r.doc_id] == r.doc_id) if r.doc_id is not None else (None, True)) for r in got)
    assert low[300] == low[105] == low[5] == 0 and low[303] == 302


def test_odd_rows(spark):
    got = minhash.op1(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == by[12].component_id == by[3].component_id == 1 and by[1].kept and not by[2].kept
    assert by[4].n_shingles == by[5].n_shingles == by[6].n_shingles == 0 and by[4].kept and by[5].kept
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert minhash.op1(no_docs(spark)).collect() == []


def test_kept_rows_keep_their_columns(spark):
    docs = odd_docs(spark, clash=True)
    got = minhash.deduplicated(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 11] and ids.count(None) == 2


def test_a_crowded_bucket_gives_no_square_of_pairs(spark):
    base = prose(8, 300).split()
    rows = [(i, " ".join(base[:i % 300] + [f"n{i}"] + base[i % 300 + 1:])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signs = minhash.signed(df, 5).selectExpr("doc_id AS id", "sig").cache()
    members = minhash.members(signs, minhash.buckets(minhash.banded(signs)))
    assert minhash.spanning(members, 80).count() < 10 * len(rows)
    signs.unpersist()
    assert {r.component_id for r in minhash.near_duplicates(df).collect()} == {0}


def test_many_apart_pairs_are_settled_in_their_buckets(spark, monkeypatch):
    """Texts around one base, mostly below the limit to each other, with some links among them."""
    base, r = prose(9, 240).split(), random.Random(1)
    rows = []
    for i in range(120):
        words = list(base)
        for k in r.sample(range(240), r.choice([2, 3, 5, 5, 5])):
            words[k] = f"w{i}x{k}"
        rows.append((i, " ".join(words)))
    want = groups(rows, 5, 80)
    assert 5 < len({c for _, c in want.values()}) < 110
    for few, block in ((8, 2048), (2, 30)):
        monkeypatch.setattr(minhash, "FEW", few)
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_signature_estimates_similarity():
    r = np.random.default_rng(3)
    a = r.integers(1, 1 << 62, 1000).astype(np.uint64)
    b = np.concatenate([a[:900], r.integers(1, 1 << 62, 100).astype(np.uint64)])
    equal = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(equal - 900 / 1100) < 0.15


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    by = defaultdict(set)
    for r in got:
        by[r.component].add(r.node)
    assert by == {0: set(range(301)), 1000: set(range(1000, 1050))}
