"""Input lag and batch time of a query: from its progress reports, and for file streams from its checkpoint."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

# Lag in rows and batch time in milliseconds that raise a flag.
MAX_LAG = 10000
MAX_BATCH_MS = 1000

SCHEMA = "batch_id long, source string, input_rows long, rows_per_second double, lag long, batch_ms long"


def _offsets(value) -> int | None:
    """Sum of the partition offsets of a topic; other sources report no comparable number."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return None
    if not isinstance(value, dict):
        return None
    total = 0
    for partitions in value.values():
        if not isinstance(partitions, dict):
            return None
        total += sum(int(v) for v in partitions.values())
    return total


def _plain(progress) -> dict:
    return json.loads(progress.json) if hasattr(progress, "json") else dict(progress)


def progress_rows(progress: list) -> list[tuple]:
    rows = []
    for report in map(_plain, progress):
        duration = int(report.get("durationMs", {}).get("triggerExecution", 0))
        for source in report.get("sources", []):
            newest, read = _offsets(source.get("latestOffset")), _offsets(source.get("endOffset"))
            lag = newest - read if newest is not None and read is not None else None
            rows.append((
                int(report["batchId"]), source["description"], int(source.get("numInputRows", 0)),
                float(source.get("inputRowsPerSecond") or 0.0), lag, duration,
            ))
    return rows


class ProgressLog(StreamingQueryListener):
    """Keeps every report of the queries that run while it is open; a query itself keeps only its last hundred."""

    def __init__(self, spark: SparkSession):
        self.spark, self.reports, self.ended = spark, {}, set()

    def __enter__(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # reports arrive in order but later than the query ends
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.reports.setdefault(str(event.progress.id), []).append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def of(self, query_id) -> list[dict]:
        return [r for r in self.reports.get(str(query_id), []) if any(s.get("numInputRows") for s in r.get("sources", []))]


def lag_report(spark: SparkSession, progress: list) -> DataFrame:
    """One row per batch and source of the given reports."""
    return spark.createDataFrame(progress_rows(progress), SCHEMA).withColumns({
        "lag_alert": F.coalesce(F.col("lag") > MAX_LAG, F.lit(False)),
        "slow_batch": F.col("batch_ms") > MAX_BATCH_MS,
    })


# ---- file streams, whose reports name no offsets that can be compared

LOGGED = "path string, timestamp long, batchId long"


def _plain_path(c: Column) -> Column:
    return F.regexp_replace(c, r"^([^:/]+):/+", r"$1:/")


def _json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a checkpoint's log, with the number of the log entry that they stand in; sums of ten entries repeat theirs."""
    lines = spark.read.text(path).select("value", F.regexp_extract("_metadata.file_name", r"^(\d+)", 1).cast("long").alias("entry"))
    return lines.filter(F.col("value").startswith("{"))


def file_lag(spark: SparkSession, source: str, checkpoint: str, source_number: int = 0, suffix: str = "*.parquet") -> DataFrame:
    """``batch_id, input_rows, lag`` of a parquet file stream: the rows that had arrived in its folder when a batch
    began and that neither this batch nor an earlier one read, with the flag ``lag_alert``.

    The source log of the checkpoint says which batch read a file, its offset log when a batch began (the engine
    keeps the last hundred); the folder's listing gives the time and rows of every file, rows from the
    footers alone. Rows per instant are summed by day first, so no window holds more than a day's instants or
    one row per day. Files that vanished from the folder, and files without rows, count nothing. A file counts as arrived
    when it is read, if its time says later.
    """
    read = _json_lines(spark, f"{checkpoint}/sources/{source_number}").select(F.from_json("value", LOGGED).alias("v")).select(
        _plain_path(F.col("v.path")).alias("path"), F.col("v.batchId").alias("batch_id")).filter("path is not null").groupBy("path").agg(F.min("batch_id").alias("batch_id"))
    began = _json_lines(spark, f"{checkpoint}/offsets").select(
        F.col("entry").alias("batch_id"), F.get_json_object("value", "$.batchTimestampMs").cast("long").alias("at")).filter("at is not null")
    listed = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", suffix).parquet(source)
    files = listed.groupBy(_plain_path(F.col("_metadata.file_path")).alias("path")).agg(
        F.count("*").alias("rows"), F.unix_millis(F.max("_metadata.file_modification_time").cast("timestamp")).alias("at"))
    known = files.join(read, "path", "left")
    taken = known.filter("batch_id is not null").groupBy("batch_id").agg(F.sum("rows").alias("input_rows"))
    batches = began.join(taken, "batch_id", "left").select("batch_id", F.coalesce("input_rows", F.lit(0)).alias("input_rows"), "at")
    # a file adds its rows when it arrives; a batch takes its own away when it begins; files of batches that the log forgot cancel out
    timed = known.join(began.select("batch_id", F.col("at").alias("began")), "batch_id", "left").filter("batch_id is null or began is not null")
    moves = timed.select(F.least("at", "began").alias("at"), "rows", F.lit(None).cast("long").alias("batch_id")).groupBy("at", "batch_id").agg(F.sum("rows").alias("rows"))
    moves = moves.withColumn("input_rows", F.lit(None).cast("long")).unionByName(batches.select("at", (-F.col("input_rows")).alias("rows"), "batch_id", "input_rows"))
    moves = moves.withColumn("day", F.floor(F.col("at") / 86_400_000))
    inside = F.sum("rows").over(Window.partitionBy("day").orderBy("at", F.asc_nulls_first("batch_id")).rowsBetween(Window.unboundedPreceding, 0))
    days = moves.groupBy("day").agg(F.sum("rows").alias("rows"))
    before = days.select("day", F.coalesce(F.sum("rows").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    lags = moves.withColumn("inside", inside).join(before, "day").filter("batch_id is not null")
    return lags.select("batch_id", "input_rows", (F.col("inside") + F.col("base")).alias("lag")).withColumn("lag_alert", F.col("lag") > MAX_LAG)
