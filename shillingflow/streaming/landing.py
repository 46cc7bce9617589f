"""Landing of an event stream, the retry loop and prompted-payment matching."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import validation as V
from ..functions.payments import PREFIX_REGIONS, phone_prefix, standardize_phone, txn_time
from ..operators import ingest, quality, stk
from ..sources.idindex import PERIOD, IdIndex
from ..sources.landing import insert_indexed
from .runner import WATERMARK, batch_path, run_available, write_batch


def with_rule(events: DataFrame, regions: bool = False) -> DataFrame:
    """The first rule that a row fails and whether it may land. With ``regions`` a number of no known
    region waits as a recoverable letter: the list of prefixes may learn it."""
    rule: Column = V.landing_rule()
    if "_corrupt" in events.columns:
        rule = F.when(F.col("_corrupt").isNotNull(), "corrupt_message").otherwise(rule)
    checked = ingest.legacy_coerce(events).withColumn("rule", rule)
    if regions:
        known = checked.withColumn("_local", standardize_phone("phone_number"))
        mapped = F.coalesce(phone_prefix("_local").isin(list(PREFIX_REGIONS)), F.lit(False))
        checked = known.withColumn("rule", F.when((F.col("rule") == "ok") & ~mapped, "unknown_region").otherwise(F.col("rule"))).drop("_local")
    return checked.withColumn("is_valid", F.col("rule") == "ok")


def land(events: DataFrame, path: str, horizon_days: int | None = None, regions: bool = False, period: str = PERIOD):
    """Batch function: validate, drop copies, append new ids, send the rest to dead letters.

    Copies of earlier batches are found in the table's id index: a batch reads only the hash buckets that
    its ids fall into and, where ``horizon_days`` says how late a copy may arrive, only those arrival periods of the index.
    Small blocks of the index are merged while the batch lands.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        index = IdIndex(batch.sparkSession, f"{path}/ids", horizon_days=horizon_days, period=period)
        checked = with_rule(batch, regions)
        checked.persist()  # read several times; lost blocks are recomputed from the source
        try:
            with ThreadPoolExecutor(1) as beside:
                merging = beside.submit(index.compact, batch_id)
                valid, letters = quality.route(checked)
                rows = valid.drop("rule", "is_valid", "_corrupt").withColumn("transaction_time", txn_time("transaction_time"))
                write_batch(insert_indexed(index, rows, batch_id), f"{path}/raw", batch_id)
                landed = batch.sparkSession.read.schema(rows.schema).parquet(batch_path(f"{path}/raw", batch_id))
                index.add(landed, batch_id)
                write_batch(letters, f"{path}/dead_letters", batch_id)
                merging.result()
        finally:
            checked.unpersist()

    return sink


def run_landing(events: DataFrame, path: str, horizon_days: int | None = None, regions: bool = False, period: str = PERIOD):
    return run_available(events, land(events, path, horizon_days, regions, period), f"{path}/checkpoint")


def retry(letters: DataFrame, path: str):
    """Dead letters to another attempt or to an incident."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        planned = quality.retry_plan(batch)
        write_batch(planned.filter("action = 'retry'").drop("action"), f"{path}/retry", batch_id)
        write_batch(planned.filter("action = 'incident'").drop("action"), f"{path}/incidents", batch_id)

    return run_available(letters, sink, f"{path}/checkpoint")


ASKED = ["initiated_at", "phone_number", "amount", "account_reference"]
TOLD = ["received_at", "result_code", "result_desc"]
EXPIRED = "checkout_request_id string, initiated_at timestamp, expired_at timestamp"


def stk_events(requests: DataFrame, callbacks: DataFrame) -> DataFrame:
    """Requests (``ask``) and callbacks with an id (``call``) as one stream of ``checkout_request_id, at, ask, call``.

    ``requests`` carries ``initiated_at``, ``callbacks`` are flattened and carry ``received_at``."""
    ask = requests.select("checkout_request_id", F.col("initiated_at").alias("at"), F.struct(*ASKED).alias("ask"))
    call = callbacks.filter(F.col("checkout_request_id").isNotNull()).select(
        "checkout_request_id", F.col("received_at").alias("at"), F.struct(*TOLD).alias("call"))
    return ask.withColumn("call", F.lit(None).cast(call.schema["call"].dataType)).unionByName(
        call.withColumn("ask", F.lit(None).cast(ask.schema["ask"].dataType)))


def stk_expiries(events: DataFrame, timeout: str = "2 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Requests whose timer runs out unanswered: ``checkout_request_id, initiated_at, expired_at``.

    A request opens a session of ``timeout``; what comes for its id inside joins the session. The watermark
    closes it, which emits the expiry of a session without a callback. A callback outside is a session of
    its own and ``settled`` lets it win. State thus holds the sessions of the last ``timeout`` and watermark
    only, and no row of it meets Python. Run it in append mode. A request that is older than the watermark
    when it comes opens none; ``settled`` sees it by its time.
    """
    is_call = F.col("call").isNotNull()
    keyed = events.filter(F.col("checkout_request_id").isNotNull() & F.col("at").isNotNull()).withWatermark("at", watermark).select(
        "checkout_request_id", "at", F.when(~is_call, F.col("at")).alias("asked_at"), is_call.alias("is_call"))
    sessions = keyed.groupBy("checkout_request_id", F.session_window("at", timeout)).agg(
        F.min("asked_at").alias("initiated_at"), F.bool_or("is_call").alias("answered"))
    return sessions.filter("initiated_at is not null and not answered").select(
        "checkout_request_id", "initiated_at", (F.col("initiated_at") + F.expr(f"INTERVAL {timeout}")).alias("expired_at"))


def run_stk(events: DataFrame, path: str, timeout: str = "2 minutes"):
    """Appends requests and callbacks under ``path`` and, by their timers, expiries. Both may be restarted."""
    recorded = run_available(events, lambda df, n: write_batch(df, f"{path}/events", n), f"{path}/checkpoint-events")
    timed = run_available(stk_expiries(events, timeout), lambda df, n: write_batch(df, f"{path}/expired", n), f"{path}/checkpoint-timers")
    return recorded, timed


def settled(events: DataFrame, expired: DataFrame) -> DataFrame:
    """One row per request with its last callback, in whatever order and however late it came; a request
    that only its timer ended reads as expired until a callback says otherwise. Copies change nothing."""
    ended = expired.select("checkout_request_id", F.lit(True).alias("ended")).distinct()
    last = events.groupBy("checkout_request_id").agg(F.min("ask").alias("ask"), F.max("call").alias("call")).filter("ask is not null")
    waiting = F.when(F.col("ended"), "expired").otherwise("initiated")
    return last.join(ended, "checkout_request_id", "left").select(
        "checkout_request_id", *[F.col(f"ask.{c}") for c in ASKED[1:]], "ask.initiated_at",
        F.when(F.col("call").isNull(), waiting).otherwise(stk.stk_status(F.col("call.result_code"))).alias("status"),
        "call.result_code", "call.result_desc", F.col("call.received_at").alias("completed_at"),
    )


def settled_at(spark: SparkSession, path: str) -> DataFrame:
    """``settled`` over what ``run_stk`` has written."""
    return settled(spark.read.parquet(f"{path}/events"), spark.read.schema(EXPIRED + ", batch long").parquet(f"{path}/expired"))


def expire(matched: DataFrame, as_of: Column, timeout: str = "2 minutes") -> DataFrame:
    """Requests that have waited longer than ``timeout`` read as expired, until a callback says otherwise."""
    late = (F.col("status") == "initiated") & (F.col("initiated_at") < as_of - F.expr(f"INTERVAL {timeout}"))
    return matched.withColumn("status", F.when(late, "expired").otherwise(F.col("status")))
