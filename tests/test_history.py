"""Stored counts per customer give the numbers that all of history gives; quantiles and broadcasts stay bounded."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shillingflow.operators import dashboards, quality, staging
from shillingflow.plans import skew
from shillingflow.sources.history import History

TX = "transaction_id string, customer_phone_number string, transaction_timestamp timestamp_ntz, loaded_at timestamp_ntz, account_reference string"


def payments(spark):
    r, rows = random.Random(4), []
    for k in range(1500):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=r.randint(0, 60 * 24 * 120)) if r.random() > 0.03 else None
        rows.append((f"T{k:05d}", r.choice(["hot", "hot", *map(str, range(20))]), at, dt.datetime(2024, 6, 1), "a"))
    return spark.createDataFrame(rows, TX).withColumn("transaction_date", F.to_date("transaction_timestamp"))


def test_numbers_equal_the_full_recomputation_after_late_increments(spark, tmp_path):
    payments(spark).write.partitionBy("transaction_date").parquet(f"{tmp_path}/tx")
    tx = spark.read.parquet(f"{tmp_path}/tx").select(*TX.replace(",", "").split()[::2], "transaction_date")
    history = History(spark, f"{tmp_path}/history").start()
    number = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    for n in range(3):
        history.add(tx.filter(number == n), n)
        history.add(tx.filter(number == n), n)  # an increment that runs again counts once
        if n < 2:
            history.snapshot(f"2024-0{n + 2}", n)
    assert history._latest("2024-04") == ("2024-03", 1) and history._latest("2024-02") == ("2024-02", 0)
    for as_of, days in (("2024-04-20 10:30:00", 7), ("2024-03-02 00:00:00", 1), ("2024-02-25 12:00:00", 20), ("2024-01-03 00:00:00", 2)):
        now = F.lit(dt.datetime.fromisoformat(as_of)).cast("timestamp_ntz")
        want = dashboards.recent(staging.with_sequence(tx), now, days, "DAYS")
        for limit in (20, 10**6):
            got = dashboards.recent_sequenced(tx, now, days, "DAYS", hot_rows=limit, history=history)
            assert got.count() == want.count() > 0 and got.exceptAll(want.select(got.columns)).isEmpty()
    plan = dashboards.recent_sequenced(tx, F.lit(dt.datetime(2024, 4, 20)).cast("timestamp_ntz"), 1, "DAYS", history=history)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("transaction_date" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans if f"{tmp_path}/tx" in line)
    assert all("month" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans if "/history/" in line)


@pytest.mark.parametrize("by", [None, ["k"]])
def test_quantiles_refine_until_a_bucket_is_small(spark, monkeypatch, by):
    monkeypatch.setattr(skew, "FINER", 8)
    seen = []
    placed = skew._placed
    monkeypatch.setattr(skew, "_placed", lambda counts, keys: seen.append(counts) or placed(counts, keys))
    i = F.col("id")
    # one power of two, most values close together, and one value that half of the rows share
    rows = spark.range(20000).select((i % 2).alias("k"), F.when(i % 4 < 2, 1.3).when(i % 4 == 2, 1.5 + i * 1e-9).otherwise(1.0 + i / 40000).alias("v"))
    probs = {"a": 0.0, "b": 0.1, "m": 0.5, "c": 0.77, "d": 0.999, "e": 1.0}
    got = skew.exact_quantiles(rows, "v", probs, by, small=40)
    plain = rows.groupBy(*(by or [])).agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()])
    assert sorted([round(x, 12) for x in r] for r in got.collect()) == sorted([round(x, 12) for x in r] for r in plain.collect())
    tasks = seen[0].groupBy(*(by or []), "_bucket", "_before").count().agg(F.max("count")).first()[0]
    assert tasks <= 40


def test_at_most_so_many_keys_are_sent_along(spark, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 30).alias("k"), F.col("id").alias("row"))
    profile = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("row").alias("top"))
    want = rows.join(profile, "k", "left").select("k", "row", "n", "top")
    for most in (3, 100):
        hot = skew._largest(profile, "n", ["k"], 10, most)
        assert hot.count() == min(most, 30)
        real = skew._largest
        monkeypatch.setattr(skew, "_largest", lambda *a, most=most: real(*a, most))
        got = skew.profile_join(rows, profile, ["k"], "n", "row", hot_rows=10)
        assert got.count() == 3000 and got.exceptAll(want).isEmpty()
        monkeypatch.setattr(skew, "_largest", real)
    plan = skew.profile_join(rows, profile, ["k"], "n", "row")._jdf.queryExecution().analyzed().toString()
    assert f"GlobalLimit {skew.MOST_HOT}" in plan


def test_model_tests_take_one_scan_per_model(spark, tmp_path):
    spark.createDataFrame([("1", "p", "5", None, "t"), ("1", None, "6", "x", "t"), (None, "p", None, "x", "t")],
                          "transaction_id string, phone_number string, amount string, transaction_time string, received_at string").write.parquet(f"{tmp_path}/m")
    got = quality.model_tests({"stg_raw_events": spark.read.parquet(f"{tmp_path}/m")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert {(r.column, r.test): r.failures for r in got.collect()} == {
        ("transaction_id", "not_null"): 1, ("phone_number", "not_null"): 1, ("amount", "not_null"): 1, ("transaction_time", "not_null"): 1,
        ("received_at", "not_null"): 0, ("transaction_id", "unique"): 1}
