"""Pages of the listing, whatever slices they fall into."""

import datetime as dt
import random

import pytest

from shillingflow.operators import lookups

SHAPE = "transaction_id string, amount decimal(12,2), phone_number string, transaction_time timestamp, transaction_status string"


def rows():
    r, out = random.Random(3), []
    start = dt.datetime(2024, 5, 1)
    for i in range(600):
        at = start + dt.timedelta(seconds=r.randrange(90_000))
        if i % 3 == 0:
            at = start + dt.timedelta(hours=5)  # a third of all payments at one instant
        out.append((f"T{r.randrange(10**6):06d}{i}", None, "p", None if i % 50 == 7 else at, "completed"))
    return [*out, out[0], out[0], (None, None, "p", start + dt.timedelta(hours=5), "completed"), ("", None, "p", None, "completed")]


def ordered(given):
    zero = dt.datetime(1970, 1, 1)
    return sorted(given, key=lambda x: (x[3] is None, -(x[3] or zero).timestamp(), x[0] is not None, x[0] or ""))


@pytest.mark.parametrize("most", [0, 7, 100_000])
def test_pages_like_a_sorted_list(spark, most):
    given = rows()
    want = [(x[0], x[3]) for x in ordered(given)]
    df = spark.createDataFrame(given, SHAPE).cache()
    for page, limit in [(1, 20), (7, 37), (16, 25), (17, 37), (604, 1), (31, 20), (32, 20)]:
        got = lookups.list_transactions(df, page=page, limit=limit, most=most).collect()
        assert [(x.transaction_id, x.transaction_time) for x in got] == want[(page - 1) * limit:page * limit]
        assert all(x.total == len(want) and x.pages == -(-len(want) // limit) for x in got)
    df.unpersist()


def test_a_late_page_sorts_one_slice(spark):
    df = spark.range(200_000).selectExpr("lpad(id, 9, '0') AS transaction_id", "timestamp_seconds(1700000000 + id DIV 4) AS transaction_time")
    total, slices = lookups.page_slices(df, 150_000, 50, 1_000)
    assert total == 200_000 and all(skip <= 1_000 for _, skip, _ in slices) and sum(take for *_, take in slices) == 50
    assert all(part.count() <= 14_400 for part, *_ in slices)


def test_repeated_rows_end_the_search(spark):
    df = spark.range(50).selectExpr("'same' AS transaction_id", "CAST(NULL AS DECIMAL(12,2)) AS amount", "'p' AS phone_number",
                                    "timestamp_seconds(1700000000) AS transaction_time", "'completed' AS transaction_status")
    assert lookups.list_transactions(df, page=3, limit=20, most=0).count() == 10
    assert lookups.list_transactions(df.limit(0), page=1).collect() == []
