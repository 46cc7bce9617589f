import math
import random

import pytest

from shillingflow.llm import topk


def brute(rows, every, k):
    real = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in dict(real).items():
        if q % every == 0:
            v = next(x for i, x in real if i == q)
            scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in real if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def rows_of(n, width, seed, scale=1.0):
    r = random.Random(seed)
    rows = [(i, [round(r.gauss(0, scale), 3) for _ in range(width)]) for i in range(n)]
    rows += [(n + i, list(rows[3][1])) for i in range(60)]  # ties beyond k
    rows += [(None, [1.0] * width), (9001, None), (9002, [None] + [0.0] * (width - 1)), (9003, [float("nan")] * width), (9020, [float("inf")] * width), (9040, [])]
    return rows


@pytest.mark.parametrize("n, width, k, scale", [(300, 16, 20, 1.0), (15, 3, 20, 1.0), (200, 7, 5, 1e5), (100, 8, 5, 1e7)])
def test_like_brute_force(spark, monkeypatch, n, width, k, scale):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "FAN", 2)
    rows = rows_of(n, width, 1, scale)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(tuple(r) for r in topk.top_k(df, 20, k).collect()) == brute(rows, 20, k)


def test_odd_tables(spark):
    shape = "vec_id long, embedding array<float>, rank int, score string"
    assert topk.op9(spark.createDataFrame([], shape)).collect() == []
    assert topk.op9(spark.createDataFrame([(20, [1.0], 1, "x")], shape)).collect() == []
    assert [tuple(r) for r in topk.op9(spark.createDataFrame([(20, [1.0], 1, "x"), (3, [-0.5], 1, "x")], shape)).collect()] == [(20, 1, 3, -2048)]
