"""Rows of a phone within the last minute, as keyed state or as a batch-wise job.

``velocity`` answers per event from keyed state; the rows of one phone and slot in one micro-batch
are handled together, so give its source a micro-batch limit. ``velocity_batches`` has no such
need: it counts before it shuffles and keeps the recent counts in a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..plans.skew import HOT_ROWS, profile_join, trailing_sums
from .runner import WATERMARK, batch_path, run_available, use_rocksdb, write_batch


class RecentCounts(StatefulProcessor):
    """Counts per instant of one phone in one time slot and the stretch just before it.

    An event counts in its own slot; one near the end of a slot is carried into the next. The
    state of a busy phone is thus spread over slots, holds counts per instant instead of events,
    forgets instants no new event can reach, and goes when the watermark passes the slot.
    """

    def __init__(self, span_us: int, slot_us: int, threshold: int):
        self.span_us, self.slot_us, self.threshold = span_us, slot_us, threshold

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "at_us array<long>, n array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # most groups are a few rows, for which a frame per group costs more than the rows
        own, at = [], []
        for row in rows:
            at.append(row["at_us"])
            if not row["carried"]:
                own.append(row)
        at = np.array(at, dtype="int64")
        weight = np.ones(len(at), dtype="int64")
        stored = self.counts.get()
        if stored is None:
            self.handle.registerTimer((int(key[1]) + 1) * self.slot_us // 1000)
        else:
            old = np.asarray(stored[0], dtype="int64")
            reachable = old > timerValues.getCurrentWatermarkInMs() * 1000 - self.span_us
            at = np.concatenate([old[reachable], at])
            weight = np.concatenate([np.asarray(stored[1], dtype="int64")[reachable], weight])
        times, place = np.unique(at, return_inverse=True)
        counts = np.bincount(place, weights=weight).astype("int64")
        self.counts.update((times.tolist(), counts.tolist()))
        if own:
            running = np.concatenate([[0], np.cumsum(counts)])
            now = np.array([row["at_us"] for row in own], dtype="int64")
            recent = (
                running[np.searchsorted(times, now, side="right")]
                - running[np.searchsorted(times, now - self.span_us, side="right")]
            ).tolist()
            names = own[0].__fields__
            kept = [i for i, name in enumerate(names) if name not in ("at_us", "slot", "carried")]
            flagged = Row(*[names[i] for i in kept], "recent_transaction_count", "velocity_flag")
            for row, n in zip(own, recent):
                yield flagged(*[row[i] for i in kept], n, n > self.threshold)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.counts.clear()
        return iter([])

    def close(self) -> None:
        pass


def velocity(events: DataFrame, key: str, ts: str, seconds: int = 60, threshold: int = 5,
             watermark: str | None = WATERMARK, slot_spans: int = 10) -> DataFrame:
    """Events with ``recent_transaction_count`` and ``velocity_flag``, by event time.

    A slot is ``slot_spans`` times the window; more makes fewer state entries, less spreads a
    busy phone further.
    """
    use_rocksdb(events.sparkSession)
    span = seconds * 1_000_000
    slot = span * slot_spans
    marked = events.withWatermark(ts, watermark) if watermark else events
    near_end = F.pmod(F.col("at_us"), F.lit(slot)) >= slot - span
    copies = F.when(near_end, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    spread = (
        marked.withColumn("at_us", F.unix_micros(ts)).withColumn("carried", F.explode(copies))
        .withColumn("slot", F.floor(F.col("at_us") / slot) + F.col("carried").cast("int"))
    )
    output = T.StructType([
        *events.schema.fields,
        T.StructField("recent_transaction_count", T.LongType()), T.StructField("velocity_flag", T.BooleanType()),
    ])
    return spread.groupBy(key, "slot").transformWithState(
        RecentCounts(span, slot, threshold), outputStructType=output, outputMode="Append", timeMode="EventTime",
    )


def velocity_batches(events: DataFrame, path: str, key: str, ts: str, row_id: str, seconds: int = 60,
                     threshold: int = 5, lateness: int = 600, hot_rows: int = HOT_ROWS, arrived: Column | None = None,
                     ahead: int = 3600):
    """Bounded run that writes flagged events to ``path/out``.

    Every batch writes the counts later batches may still need, under its own number; a replay
    reads the counts of the batch before it and overwrites its own. What later batches need is
    measured from the middle of a batch, so a few wrong stamps don't make it forget; rows stamped
    more than ``ahead`` seconds after they ``arrived`` (by default now) go to ``path/future``.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        limit = (F.current_timestamp() if arrived is None else arrived) + F.expr(f"INTERVAL {int(ahead)} SECONDS")
        future = F.coalesce(F.col(ts) > limit, F.lit(False))
        write_batch(batch.filter(future), f"{path}/future", batch_id)
        batch = batch.filter(~future)
        counts = batch.groupBy(key, ts).agg(F.count("*").alias("rows_at"))
        if batch_id > 0:
            earlier = spark.read.schema(counts.schema).parquet(batch_path(f"{path}/counts", batch_id - 1))
            counts = counts.unionByName(earlier).groupBy(key, ts).agg(F.sum("rows_at").alias("rows_at"))
        micros = batch.agg(F.percentile_approx(F.unix_micros(ts), 0.5)).first()[0]
        middle = F.timestamp_micros(F.lit(micros)) if micros is not None else F.lit(None).cast("timestamp")
        keep = F.coalesce(F.col(ts) > middle - F.expr(f"INTERVAL {int(seconds + lateness)} SECONDS"), F.lit(True))
        write_batch(counts.filter(keep), f"{path}/counts", batch_id)
        recent = trailing_sums(counts, [key], ts, seconds, "recent_transaction_count")
        flagged = profile_join(batch, recent, [key, ts], "rows_at", row_id, hot_rows).drop("rows_at").withColumn(
            "velocity_flag", F.col("recent_transaction_count") > threshold
        )
        write_batch(flagged, f"{path}/out", batch_id)

    return run_available(events, sink, f"{path}/checkpoint")
