"""Backlog of a file stream from its checkpoint."""

import time

from shillingflow.session import shared_dir
from shillingflow.streaming import lag
from shillingflow.streaming.runner import run_available, write_batch


def test_files_that_arrive_between_runs(spark):
    folder, out, checkpoint = (shared_dir(spark, f"test-lag-{x}") for x in ("in", "out", "checkpoint"))

    def arrive(name, rows):
        spark.range(rows).coalesce(1).write.parquet(f"{folder}/{name}")
        time.sleep(0.05)

    def run():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(folder)
        run_available(stream, lambda df, n: write_batch(df, out, n), checkpoint)

    arrive("a", 100)
    run()
    arrive("b", 20_000)
    arrive("c", 12_000)
    arrive("d", 300)
    run()
    arrive("e", 70)  # nobody read it and no batch began since
    got = sorted(map(tuple, lag.file_lag(spark, folder, checkpoint).select("batch_id", "input_rows", "lag", "lag_alert").collect()))
    assert got == [(0, 100, 0, False), (1, 20_000, 12_300, True), (2, 12_000, 300, False), (3, 300, 0, False)]


def test_many_batches_pass_a_summed_log(spark):
    folder, out, checkpoint = (shared_dir(spark, f"test-lag-{x}") for x in ("in", "out", "checkpoint"))
    spark.range(0, 240, 1, 24).write.parquet(folder)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 2).parquet(folder)
    run_available(stream, lambda df, n: write_batch(df, out, n), checkpoint)
    got = sorted(map(tuple, lag.file_lag(spark, folder, checkpoint).select("batch_id", "input_rows", "lag").collect()))
    assert got == [(i, 20, 240 - 20 * (i + 1)) for i in range(12)]
