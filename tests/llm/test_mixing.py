import re

import pytest

from shillingflow.llm import mixing

from .helpers import no_docs, odd_docs, odd_rows


def filled(sizes):
    """Targets by sharing, stopping and sharing again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(3 * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in full else share[s] for s in names}
        full |= above


def source_rows(spark):
    rows = [(i, "w " * (1 + (i * 37) % 90), "en", s, 1) for i in range(3000)
            for s in [["big", "big", "big", "mid", "mid", "zz", None][i % 7] if i % 50 else "tiny"]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_targets_are_met(spark):
    docs = source_rows(spark)
    sizes = {r.source: r.n for r in docs.selectExpr("source", "size(split(trim(text), ' ')) AS n").groupBy("source").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    want = filled(sizes)
    got = mixing.op6(docs).toPandas().merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    got["source"] = got["source"].fillna("(null)")
    assert (got.taken <= 3 * got["size"]).all() and want["tiny"] == 3 * sizes["tiny"]
    for source, part in got.groupby("source"):
        key = None if source == "(null)" else source
        assert part.source_size.unique().tolist() == [sizes[key]]
        assert part.target.iloc[0] == pytest.approx(want[key])
        assert part.taken.sum() == pytest.approx(want[key], rel=0.01)
    again = mixing.op6(docs.repartition(5)).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_rates_are_tilted_exponentially(spark):
    counts = spark.createDataFrame([(1, s, 10) for s in range(1, 101)], "sid long, size long, n long")
    total = 10 * sum(range(1, 101))
    sources = spark.createDataFrame([(1, 0.5 * total, total, 100)], "sid long, target double, source_size long, largest long")
    found = mixing.balance(counts, sources).first().multiplier
    rates = [2.718281828459045 ** (found * s / 100) for s in range(1, 101)]
    assert found < 0 and sum(10 * s * r for s, r in zip(range(1, 101), rates)) == pytest.approx(0.5 * total, rel=1e-6)


def test_blocks_of_a_source_are_rounded_apart(spark):
    docs = source_rows(spark)
    got = mixing.mix(mixing.sized_documents(docs), block=100).toPandas()
    for _, part in got.groupby("sid"):
        assert (part.copies * part["size"]).sum() == pytest.approx(part.target.iloc[0], rel=0.02)


def test_odd_rows(spark):
    got = mixing.op6(odd_docs(spark)).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in odd_rows()]
    assert sorted(r["size"] for r in got) == sorted(words)
    assert mixing.op6(no_docs(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, "en", "a", 1), (2, "", "en", None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [(r.taken, r.target) for r in mixing.op6(nothing).collect()] == [(0, 0.0)] * 2


def test_copies_keep_all_columns(spark):
    docs = odd_docs(spark, clash=True)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r._copy for r in rows} == {"mine"} and max(sum(x.doc_id == r.doc_id for x in rows) for r in rows if r.doc_id not in (None, 9)) <= 3
