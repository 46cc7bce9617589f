"""The id index: blocks, pruning, equality with an anti join over everything, replays."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shillingflow.sources import landing
from shillingflow.sources.idindex import IdIndex

ROWS = "transaction_id string, received_at timestamp, payload string"


def test_blocks_cover_all_earlier_batches_once_and_stay_few():
    index = IdIndex(None, "x", fan=4)
    for n in range(300):
        blocks = index.blocks(n)
        assert [x for a, b in blocks for x in range(a, b)] == list(range(n))
        assert len(blocks) <= 1 + 3 * 5
    written = set()
    for n in range(300):  # what a batch reads was written before it and not emptied yet
        assert set(index.blocks(n)) <= written
        for whole, parts in index._complete(n):
            assert set(parts) <= written
            written.add(whole)
        for _, parts in index._complete(n - 1) if n else []:
            written -= set(parts)
        assert set(index.blocks(n)) <= written
        written.add((n, n + 1))


def _batches(seed, many):
    r = random.Random(seed)
    return [[(None if r.random() < 0.1 else str(r.randint(0, 60)), dt.datetime(2024, 1, 1) + dt.timedelta(days=9 * n, minutes=r.randint(0, 600)), f"{n}-{k}")
             for k in range(25)] for n in range(many)]


def test_equals_the_anti_join_over_everything(spark, tmp_path):
    index, landed = IdIndex(spark, f"{tmp_path}/ids", buckets=4, fan=2), []
    for n, rows in enumerate(_batches(3, 6)):
        df = spark.createDataFrame(rows, ROWS)
        for _ in range(2 if n in (2, 4) else 1):  # two batches run again
            index.compact(n)
            out = [tuple(x) for x in landing.insert_indexed(index, df, n).collect()]
            index.add(spark.createDataFrame(out, ROWS), n)
        target = spark.createDataFrame(landed, ROWS)
        assert sorted(map(str, out)) == sorted(str(tuple(x)) for x in landing.insert_ignore(target, df).collect())
        landed += out
    assert len({x[0] for x in landed if x[0]}) == sum(x[0] is not None for x in landed)


def test_a_batch_reads_only_its_buckets_and_periods(spark, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/ids", buckets=16, period="day", horizon_days=5)
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=k) for k in range(20)]
    index.add(spark.createDataFrame([(f"{k}-{j}", day, "") for k, day in enumerate(days) for j in range(30)], ROWS), 0)
    batch = spark.createDataFrame([("12-3", days[19], ""), ("19-3", days[19], ""), ("new", days[19], "")], ROWS)
    part, n = index.stored(batch, 1)
    plan = part._jdf.queryExecution().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "bucket" in filters and "since" in filters and n == 3
    files = {x.split("since=")[1] for x in part.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert len({x.split("/")[0] for x in files}) <= 6 and len({x.split("bucket=")[1].split("/")[0] for x in files}) <= 3
    assert sorted(r.id for r in index.held(batch, 1).collect()) == ["19-3"]  # the other lies beyond the horizon


def test_first_row_takes_one_scan_and_one_exchange_and_spreads_rows_without_id(spark, tmp_path):
    rows = [(None, dt.datetime(2024, 1, 1), str(k % 3)) for k in range(400)] + [("a", dt.datetime(2024, 1, k % 9 + 1), str(k)) for k in range(400)]
    spark.createDataFrame(rows, ROWS).repartition(4).write.parquet(f"{tmp_path}/feed")
    feed = spark.read.parquet(f"{tmp_path}/feed")
    for df in (landing.first_per_id(feed), landing.confirm_upsert(feed)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
        assert df.count() == 401
    spread = landing.first_per_id(feed).withColumn("task", F.spark_partition_id()).filter("transaction_id is null").groupBy("task").count().collect()
    assert len(spread) >= 1 and sum(r["count"] for r in spread) == 400
