"""Landing of events: insert-ignore, confirmation upsert, plain append.

There is no table format with MERGE here, so each function returns the rows to write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payments import from_time, interval
from .idindex import IdIndex


def _sortable(df: DataFrame, names: list[str]) -> list:
    """Columns that can be compared; maps are compared by their text."""
    return [F.to_json(c) if df.schema[c].dataType.typeName() in ("map", "variant") else F.col(c) for c in names]


def _apart(key: str):
    """0 for rows with an id; rows without one each get a number of their own, so none is another's copy
    and they are spread over all tasks."""
    return F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(0)


def first_per_id(events: DataFrame, key: str = "transaction_id", order: str = "received_at") -> DataFrame:
    """Earliest row per id; rows without an id are all kept. Ties go to the smallest remaining columns.

    One aggregate over one scan: copies are dropped before the exchange as well as after it, so a heavily
    repeated id sends one row per task.
    """
    rest = [c for c in events.columns if c not in (key, order)]
    whole = F.struct(order, *rest)
    sortable = not any(events.schema[c].dataType.typeName() in ("map", "variant") for c in rest)
    first = (F.min(whole) if sortable else F.min_by(whole, F.struct(order, *_sortable(events, rest)))).alias("_first")
    return events.groupBy(key, _apart(key).alias("_apart")).agg(first).select(key, "_first.*").select(*events.columns)


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows to append: the first arrival of every id the target does not hold yet.

    It reads all ids of the target; ``insert_indexed`` doesn't."""
    held = target.filter(F.col(key).isNotNull()).select(key).distinct()  # copies in the target shrink before the shuffle
    return _without(first_per_id(incoming, key), held, key)


def _without(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not held. Rows without an id are no copies; each looks for a text that no id has, so
    they don't meet in one task."""
    probe = F.when(F.col(key).isNull(), F.concat(F.lit("\0"), F.monotonically_increasing_id())).otherwise(F.col(key).cast("string"))
    return rows.withColumn("_probe", probe).join(held.select(F.col(held.columns[0]).cast("string").alias("_probe")), "_probe", "left_anti").select(
        *rows.columns)


def insert_indexed(index: IdIndex, incoming: DataFrame, batch_id: int) -> DataFrame:
    """As ``insert_ignore`` against all earlier batches of a table with an id index: only the buckets and days
    that the batch can meet are read. Hand what was written to ``index.add``."""
    return _without(first_per_id(incoming, index.key, index.arrival), index.held(incoming, batch_id), index.key)


def confirm_upsert(events: DataFrame, key: str = "transaction_id", order: str = "received_at",
                   replaced: str = "payload") -> DataFrame:
    """State of the table after all confirmations: first values, last payload, status confirmed.

    Pass the union of the stored table and the new events to merge into an existing table. One aggregate
    over one scan: copies of an id are merged before the exchange as well as after it.
    """
    kept = [c for c in events.columns if c not in (key, order, replaced)]
    merged = events.groupBy(key, _apart(key).alias("_apart")).agg(
        F.min_by(F.struct(order, *kept), F.struct(order, *_sortable(events, kept))).alias("_first"),
        F.max(F.struct(order, replaced)).alias("_last"), F.count(F.lit(1)).alias("_n"))
    return merged.select(
        key, "_first.*", F.col(f"_last.{replaced}").alias(replaced), F.when(F.col("_n") > 1, F.col(f"_last.{order}")).alias("updated_at"),
    ).select(*events.columns, "updated_at", F.lit("confirmed").alias("status"))


def append_plain(events: DataFrame, path: str) -> None:
    """Older landing: every arrival is kept, copies included."""
    events.write.mode("append").parquet(path)


def windowed_scan(payments: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` days for the analyses."""
    return from_time(payments, as_of - interval(days, "DAYS")).select(
        "transaction_id", "phone_number", "amount", "transaction_time", "business_shortcode",
        *[c for c in ("region", "reference", "payment_method") if c in payments.columns],
    )
