"""Per-event enrichment, rules, deduplication, windows, alerts and sinks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import payments as P
from ..sources.files import to_messages
from .runner import WATERMARK


def enrich(events: DataFrame, amount: str = "TransAmount", phone: str = "MSISDN") -> DataFrame:
    return events.withColumns({
        "amount_category": P.amount_category(F.col(amount).cast("double")),
        "phone_standardized": P.standardize_phone(phone),
        "processed_at": F.current_timestamp(),
    })


def rules(events: DataFrame, amount: str = "TransAmount", max_single: float = P.MAX_SINGLE) -> DataFrame:
    return events.withColumns(P.anomaly_columns(amount, max_single=max_single))


def _first_copies(key: str):
    """Drops, within each Arrow batch, all but the first row of an id; rows without one stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(key))
            codes = ids.dictionary_encode().indices
            _, first = np.unique(codes.drop_null().to_numpy(zero_copy_only=False), return_index=True)
            known = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
            keep = np.sort(np.concatenate([known[first], np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))]))
            yield batch if len(keep) == batch.num_rows else batch.take(pa.array(keep))
    return run


def dedupe(events: DataFrame, key: str = "TransID", ts: str = "event_time", memory: str = "24 hours") -> DataFrame:
    """First event per id within ``memory``; events without an id all pass.

    One stateful step holds every id once and drops it when ``memory`` is over. Copies inside a micro-batch
    are reduced before the shuffle, so a heavily repeated id reaches the task that owns it a few times per
    micro-batch, however many copies there are.
    """
    few = events.filter(F.col(key).isNotNull()).mapInArrow(_first_copies(key), events.schema)
    return few.withWatermark(ts, memory).dropDuplicatesWithinWatermark([key]).unionByName(
        events.withWatermark(ts, memory).filter(F.col(key).isNull()))


def category_windows(events: DataFrame, size: str, slide: str | None = None, ts: str = "event_time",
                     amount: str = "TransAmount", watermark: str = WATERMARK) -> DataFrame:
    """Totals per window and amount category, kept as running partial aggregates."""
    value, category = F.col(amount), F.col("amount_category")
    return (
        events.withWatermark(ts, watermark).groupBy(F.window(ts, size, slide or size), category.alias("key"))
        .agg(
            F.count("*").alias("transaction_count"), F.sum(value).alias("total_amount"), F.avg(value).alias("avg_amount"),
            *[F.count_if(category == c).alias(f"{c}_count") for c in ("low", "medium", "high")],
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "key",
                "transaction_count", "total_amount", "avg_amount", "low_count", "medium_count", "high_count")
    )


def hourly(events: DataFrame, **kw) -> DataFrame:
    return category_windows(events, "1 hour", **kw)


def sliding(events: DataFrame, **kw) -> DataFrame:
    return category_windows(events, "15 minutes", "5 minutes", **kw).drop(
        "avg_amount", "low_count", "medium_count", "high_count"
    )


def aggregate_messages(windows: DataFrame, aggregation_type: str) -> DataFrame:
    """Window rows for the shared aggregate topic, told apart by ``aggregation_type``."""
    return to_messages(windows.withColumn("aggregation_type", F.lit(aggregation_type)), "key")


def newest_messages(messages: DataFrame, version: str = "batch") -> DataFrame:
    """The last message of every window, key and aggregate: each update repeats the whole window."""
    window = [F.get_json_object("value", f"$.{c}").alias(f"_{c}") for c in ("aggregation_type", "window_start", "window_end")]
    last = messages.select("key", *window, "value", version).groupBy("key", "_aggregation_type", "_window_start", "_window_end").agg(
        F.max_by("value", version).alias("value"))
    return last.select("key", "value")


def alerts(checked: DataFrame) -> DataFrame:
    """Anomalies and velocity hits; reads the stream after the velocity step."""
    hit = F.coalesce("anomaly_flag", F.lit(False)) | F.coalesce("velocity_flag", F.lit(False))
    return checked.filter(hit)


def minute_rate(events: DataFrame, ts: str, watermark: str = WATERMARK) -> DataFrame:
    return (
        events.withWatermark(ts, watermark).groupBy(F.window(ts, "1 minute")).agg(F.count("*").alias("raw_events"))
        .select(F.col("window.start").alias("time"), "raw_events")
    )


def live_customers(events: DataFrame, ts: str, phone: str, size: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """Distinct customers per window; a sketch, because a stream cannot keep every number."""
    return (
        events.withWatermark(ts, watermark).groupBy(F.window(ts, size))
        .agg(F.approx_count_distinct(phone, 0.01).alias("unique_customers"))
        .select(F.col("window.start").alias("time"), "unique_customers")
    )
