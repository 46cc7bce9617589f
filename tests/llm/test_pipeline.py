"""The stages against brute force, each on what the one before kept."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from shillingflow.llm import mixing, quality, tokens
from shillingflow.session import write_out

from .helpers import DOCS, no_docs, odd_docs, prose
from .test_minhash import groups
from .test_quality import plain_statistics


def documents(spark):
    page = prose(70, 80)
    rows = [(i, prose(i, 60 + i), "en", f"s{i % 4}", 1) for i in range(40)]
    rows += [(50 + i, " ".join(prose(i, 60 + i).split()[:-1] + ["changed"]), "en", "s1", 1) for i in range(5)]
    rows += [(60 + i, f"{prose(200 + i, 70)} {page} {prose(300 + i, 70)}", "en", "s2", 1) for i in range(5)]
    rows += [(80, "too short", "en", "s0", 1), (81, None, None, None, None), (82, "again and again " * 50, "en", "s0", 1)]
    return spark.createDataFrame(rows, DOCS)


def test_stages_like_brute_force(spark):
    docs = documents(spark)
    rows = {r.doc_id: r for r in docs.collect()}
    one, two, three, four, five = (stage for _, stage in pipeline.STAGES)

    kept = write_out(one(spark, docs, ""), "test")
    bad = {d for d, r in rows.items() for n, *_, rep in [plain_statistics(r.text)] if n < 50 or 100 * rep > 50 * n}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(rows) - bad and bad == {80, 81, 82}

    near = write_out(two(spark, kept, ""), "test")
    found = groups([(d, rows[d].text) for d in sorted(set(rows) - bad)], 5, 80)
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, c in found.values()})

    cut = write_out(three(spark, near, ""), "test")
    assert cut.columns == docs.columns
    low, want = {}, {}
    for r in sorted(near.collect()):
        b = r.text.encode()
        gone = bytearray(len(b))
        for q in range(len(b) - 49):
            if low.setdefault(b[q:q + 50], r.doc_id) < r.doc_id:
                gone[q:q + 50] = b"\1" * 50
        want[r.doc_id] = bytes(x for x, g in zip(b, gone) if not g).decode()
    got = {r.doc_id: r for r in cut.collect()}
    assert {d: r.text for d, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    assert want[60] == rows[60].text and len(want[64]) < len(rows[64].text) - 200

    mixed = write_out(four(spark, cut, ""), "test")
    taken = {r.doc_id: r.taken for r in mixing.op6(cut).collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and all(times[d] * len(r.text.split()) == taken[d] for d, r in got.items()) and max(times.values()) <= 3

    packed = five(spark, mixed, "").collect()
    library = tokens.Encoder(tokens.vocabulary()).library
    ids = Counter((r.doc_id, tuple(tokens.unpack_ids(r.ids).tolist())) for r in packed)
    assert ids == Counter({(d, tuple([*library.encode(got[d].text, add_special_tokens=False).ids, 0])): n for d, n in times.items()})
    by = sorted(packed, key=lambda r: (r.sequence_id, r.offset))
    assert all(b.offset == (a.offset + a.length if a.sequence_id == b.sequence_id else 0) for a, b in zip(by, by[1:]))


@pytest.mark.parametrize("clash", [False, True])
def test_every_stage_takes_odd_rows(spark, clash):
    for k, (name, stage) in enumerate(pipeline.STAGES):
        docs = odd_docs(spark, clash)
        got = stage(spark, docs, "")
        got.collect()
        assert name == "pack_sequences" or got.columns == docs.columns
        assert stage(spark, no_docs(spark), "").collect() == []


def test_run(spark):
    assert pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
    assert quality.LEAST_WORDS == 50
