"""The file stream of a table: all rows, oldest first, in files that many tasks write."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shillingflow.catalog import streams
from shillingflow.session import shared_dir
from shillingflow.streaming.runner import run_available


@pytest.mark.parametrize("partitions, files", [(1, 1), (12, 4)])
def test_source_keeps_rows_without_a_time_and_all_tasks(spark, partitions, files):
    i = F.col("id")
    rows = spark.range(0, 600, 1, partitions).select(
        i.alias("event_id"), F.when(i % 50 != 7, F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(id as int))")).alias("ts"),
        (i % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    batches = []

    def keep(df, n):
        got = df.select("event_id", "ts", F.col("_metadata.file_path").alias("file")).collect()
        batches.append(got)

    run_available(streams.source(SimpleNamespace(spark=spark, table=lambda name: rows), "events").select("*", "_metadata"), keep, shared_dir(spark, "test-source"))
    assert len(batches) == streams.BATCHES
    assert sorted(r.event_id for b in batches for r in b) == list(range(600))
    times = [[r.ts for r in b if r.ts] for b in batches]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:]))
    assert {r.event_id for r in batches[0]} >= {e for e in range(600) if e % 50 == 7}
    assert all(len({r.file for r in b}) == files for b in batches)


def test_small_parts_still_make_a_batch_each(spark):
    rows = spark.createDataFrame([(n, None, 1, "view", 1.0, "{}") for n in range(2)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").unionByName(
        spark.range(0, 6, 1, 9).selectExpr("id + 2 AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(id as int)) AS ts", "1L AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props"))
    seen = []
    run_available(streams.source(SimpleNamespace(spark=spark, table=lambda name: rows), "events"), lambda df, n: seen.append([r.event_id for r in df.collect()]), shared_dir(spark, "test-source"))
    assert len(seen) == streams.BATCHES and sorted(sum(seen, [])) == list(range(8))
