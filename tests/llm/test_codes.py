"""Vector codes against plain rounds without bounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from shillingflow.llm import codes

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    real = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in real), default=0) // parts)
    real = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in real]
    first = sorted(real, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    x = np.array([v for _, v, _ in real], dtype=np.int64).reshape(len(real), parts, width)
    book = np.array([v for _, v, _ in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()

    def near():
        d = ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(rounds):
        a, _ = near()
        for p in range(parts):
            for e in range(len(first)):
                if (a[:, p] == e).any():
                    book[p, e] = x[a[:, p] == e, p].sum(axis=0) // int((a[:, p] == e).sum())
    a, d = near()
    error, sums = d.sum(axis=1), {}
    for (_, _, label), e in zip(real, error):
        sums[label] = sums.get(label, 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return sorted(((i, bytes(a[k].astype(np.uint8)).hex(), int(error[k]), sums[label], digest) for k, (i, _, label) in enumerate(real)), key=repr)


def clustered(seed, n, dim, spread):
    r = random.Random(seed)
    heads = [[r.gauss(0, 0.2) for _ in range(dim)] for _ in range(12)]
    return [(i, [x + r.gauss(0, spread) for x in r.choice(heads)], r.choice([None, 1, 2, 3])) for i in range(n)]


@pytest.mark.parametrize("dim,spread", [(16, 0.02), (8, 0.3), (20, 0.0005)])
def test_equals_plain_rounds(spark, dim, spread):
    rows = clustered(dim, 900, dim, spread)
    df = spark.createDataFrame(rows, ROWS).repartition(7).selectExpr("*", "'c' AS codes", "1 AS v", "2 AS error", "'z' AS of_label")
    assert sorted((tuple(r) for r in codes.op11(df).collect()), key=repr) == plain(rows)


def test_odd_vectors(spark):
    v = [0.5, -0.25, 0.125, 1.0, 2.0, 3.0, -1.0, 0.0]
    rows = [(1, v, 1), (1, v, 1), (2, None, 1), (3, [0.1, None, 0.2], 1), (4, [float("nan")] * 8, 2), (5, [float("inf")] * 8, 2), (None, v[::-1], None),
            (6, [0.0] * 8, None), (7, [], 5), (8, [1.0], 5), (1, v[::-1], 1)]
    assert sorted((tuple(r) for r in codes.op11(spark.createDataFrame(rows, ROWS)).collect()), key=repr) == plain(rows)
    assert codes.op11(spark.createDataFrame([], ROWS)).collect() == []
    assert codes.op11(spark.createDataFrame([(1, None, 1)], ROWS)).collect() == []
    assert [r["code"] for r in codes.op11(spark.createDataFrame([(1, [], 1)], ROWS)).collect()] == ["00000000"]


def test_huge_components_count_as_the_bound(spark):
    rows = [(k, [x, -x, 0.5, 1.0], 1) for k, x in enumerate([1e30, 3e38, 20000.0, 1.0, 2.0])]
    held = [(k, [max(min(x, 16384.0), -16384.0) for x in v], label) for k, v, label in rows]
    assert sorted((tuple(r) for r in codes.op11(spark.createDataFrame(rows, ROWS)).collect()), key=repr) == plain(held)


def test_bounds_save_rescans(spark):
    rows = spark.createDataFrame(clustered(1, 1500, 16, 0.02), ROWS)
    full, _ = codes.compress(rows, 0)
    last, books = codes.compress(rows, 4)
    share = last.agg({"scans": "sum"}).first()[0] / full.agg({"scans": "sum"}).first()[0]
    assert share < 0.7 and len(books.rounds) == 5


def test_net_displacement_is_at_most_the_sum_of_moves():
    r = np.random.default_rng(3)
    books = codes.Codebooks(r.integers(-500, 500, (4, 64, 4)))
    for _ in range(4):
        books.rounds.append(books.rounds[-1] + r.integers(-40, 40, (4, 64, 4)))
    for p in range(4):
        net = books.moved(p)
        steps = np.array([np.sqrt(((b[p] - a[p]) ** 2).sum(axis=1)) for a, b in zip(books.rounds, books.rounds[1:])])
        for k, g in enumerate(books.groups[p]):
            summed = [steps[s:, g].max(axis=1).sum() for s in range(5)]
            assert (net[k] <= np.array(summed) * (1 + 1e-5) + 1e-9).all() and net[k][4] == 0
