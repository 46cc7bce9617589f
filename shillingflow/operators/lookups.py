"""Lookups, listings and summaries served to the API."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import payments as P

AMOUNT = "transaction_amount"
TIME = "transaction_timestamp"
PHONE = "customer_phone_number"


def account_refs(tx: DataFrame) -> DataFrame:
    return tx.select(F.coalesce("account_reference", F.lit("Unassigned")).alias("account_reference")).distinct().orderBy(
        "account_reference"
    )


def txn_by_id(tx: DataFrame, transaction_id: str) -> DataFrame:
    return tx.filter(F.col("transaction_id") == transaction_id).limit(1)


def txns_by_phone(tx: DataFrame, phone: str, limit: int = 100) -> DataFrame:
    return tx.filter(F.col(PHONE) == phone).orderBy(F.desc(TIME), "transaction_id").limit(limit)


def daily_summary(daily: DataFrame, day: str) -> DataFrame:
    return daily.filter(F.col("transaction_date") == F.lit(day).cast("date")).orderBy(
        F.desc("total_transaction_value"), PHONE
    )


def heatmap_data(heatmap: DataFrame, day: str) -> DataFrame:
    return heatmap.filter(F.col("transaction_date") == F.lit(day).cast("date")).orderBy(
        F.desc("transaction_count"), "account_reference"
    )


def txn_statistics(tx: DataFrame, start: str, end: str) -> DataFrame:
    return tx.filter(F.col("transaction_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).agg(
        F.count("*").alias("total_transactions"),
        F.sum(AMOUNT).cast("double").alias("total_amount"),
        P.exact_mean(AMOUNT).alias("avg_amount"),
        F.min(AMOUNT).cast("double").alias("min_amount"),
        F.max(AMOUNT).cast("double").alias("max_amount"),
        F.countDistinct(PHONE).alias("unique_customers"),
    )


def top_merchants(tx: DataFrame, limit: int = 10) -> DataFrame:
    return (
        tx.groupBy("account_reference").agg(
            F.count("*").alias("transaction_count"),
            F.sum(AMOUNT).cast("double").alias("total_amount"),
            P.exact_mean(AMOUNT).alias("avg_amount"),
        )
        .orderBy(F.desc("transaction_count"), F.asc_nulls_first("account_reference")).limit(limit)
    )


def hourly_trend(tx: DataFrame, day: str) -> DataFrame:
    """Hours of one day, truncated from the timestamp so that hours stay apart."""
    return tx.filter(F.col("transaction_date") == F.lit(day).cast("date")).groupBy(
        P.trunc_ts("hour", TIME).alias("hour")
    ).agg(F.count("*").alias("transaction_count"), F.sum(AMOUNT).cast("double").alias("total_amount"))


SLICE = 100_000  # rows; a slice of the listing with more rows before its page is divided again
#: Orders of ever finer slices, newest first; the last ones divide payments of one instant by their ids.
NEWEST = [(lambda k=k: P.trunc_ts(k, "transaction_time"), True) for k in ("hour", "second")] + [(lambda: F.col("transaction_time"), True)]


def _levels():
    yield from NEWEST
    n = 0
    while True:
        n += 2
        yield (lambda n=n: F.substring("transaction_id", 1, n)), False


def page_slices(kept: DataFrame, skip: int, take: int, most: int = SLICE) -> tuple[int, list[tuple[DataFrame, int, int]]]:
    """The number of rows, and the slices that hold the page, newest first, each with the rows to skip and take in it.

    Counts per hour find the hours of the page. Where more than ``most`` rows of its first slice come before the
    page, counts per second, per instant and per leading part of the ids narrow that slice, so what is sorted for
    a page never grows with its number. Equal rows cannot be told apart and end the search.
    """
    total, slices, part = None, [], kept
    for level, falling in _levels():
        key = level()
        order = F.desc_nulls_last("_key") if falling else F.asc_nulls_first("_key")
        counts = part.groupBy(key.alias("_key")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))  # one row per slice
        counts = counts.select("_key", "n", upto.alias("upto"), F.sum("n").over(Window.partitionBy()).alias("total"))
        met = counts.filter((F.col("upto") > skip) & (F.col("upto") - F.col("n") < skip + take) | (F.col("upto") == F.col("total"))).orderBy("upto").collect()
        if not met:
            return total or 0, slices
        if total is None:
            total = met[0]["total"]
        met = [r for r in met if r["upto"] > skip and r["upto"] - r["n"] < skip + take]  # at most one per row of the page
        if not met:
            return total, slices
        first, later = met[0], met[1:]
        here = min(take, first["upto"] - skip)
        if later:
            ends = [r["_key"] for r in later]
            slices.insert(0, (part.filter(_within(part, key, falling, ends)), 0, take - here))
        skip, take = skip - (first["upto"] - first["n"]), here
        same = met[0]["n"] == met[0]["total"] and not falling and part.filter(key != F.col("transaction_id")).isEmpty()
        part = part.filter(_within(part, key, falling, [first["_key"]]))
        if skip <= most or same:
            return total, [(part, skip, take), *slices]


def _within(rows: DataFrame, key: Column, falling: bool, values: list) -> Column:
    """Rows of the given neighbouring slices; the stored date is named too, so that only its partitions are read."""
    told = [v for v in values if v is not None]
    inside = key.isNull() if len(told) < len(values) else F.lit(False)
    if told:
        inside = inside | key.between(F.lit(min(told)), F.lit(max(told)))
        if falling and len(told) == len(values):
            inside = inside & P.day_of(rows).between(F.to_date(F.lit(min(told))), F.to_date(F.lit(max(told))))
    return inside


def list_transactions(payments: DataFrame, phone: str | None = None, status: str | None = None,
                      start_date: str | None = None, end_date: str | None = None,
                      min_amount: float | None = None, max_amount: float | None = None,
                      page: int = 1, limit: int = 50, most: int = SLICE) -> DataFrame:
    """One page, newest first, with the total and the number of pages on each row.

    Only the slices that hold the page are sorted, whatever its number (see ``page_slices``).
    """
    if not 1 <= limit <= 1000 or page < 1:
        raise ValueError("limit must be 1 to 1000 and page at least 1")
    kept = payments
    if phone is not None:
        kept = kept.filter(F.col("phone_number") == P.normalize_ke_phone(F.lit(phone)))
    if status is not None:
        kept = kept.filter(F.col("transaction_status") == status)
    if start_date is not None:
        kept = kept.filter(P.day_of(kept) >= F.lit(dt.date.fromisoformat(start_date)))
    if end_date is not None:
        kept = kept.filter(P.day_of(kept) <= F.lit(dt.date.fromisoformat(end_date)))
    if min_amount is not None:
        kept = kept.filter(F.col("amount") >= F.lit(str(min_amount)).cast("decimal(12,2)"))
    if max_amount is not None:
        kept = kept.filter(F.col("amount") <= F.lit(str(max_amount)).cast("decimal(12,2)"))
    newest = [F.desc("transaction_time"), F.asc("transaction_id")]
    total, slices = page_slices(kept, (page - 1) * limit, limit, most)
    parts = [part.orderBy(*newest).offset(skip).limit(take) for part, skip, take in slices]
    rows = reduce(DataFrame.unionByName, parts) if parts else kept.limit(0)
    return rows.orderBy(*newest).select(
        "transaction_id", F.col("amount").cast("double").alias("amount"), "phone_number",
        "transaction_time", "transaction_status",
        F.lit(total).cast("bigint").alias("total"), F.lit(-(-total // limit)).cast("bigint").alias("pages"))


def customer_history(tx: DataFrame, phone: str, limit: int = 50, names: DataFrame | None = None) -> DataFrame:
    """Name and totals of a customer and the newest ``limit`` payments as an array.

    ``names`` has ``phone_number`` and ``customer_name``, as callbacks carry them; of several names the last by alphabet."""
    mine = tx.filter(F.col(PHONE) == phone)
    name = F.lit(None).cast("string")
    if names is not None:
        name = names.filter(F.col("phone_number") == phone).agg(F.max("customer_name")).scalar()
    totals = mine.agg(F.count("*").alias("n"), F.sum(AMOUNT).cast("double").alias("total"))
    newest = mine.orderBy(F.desc(TIME), "transaction_id").limit(limit).agg(
        F.sort_array(
            F.collect_list(F.struct(TIME, "transaction_id", F.col(AMOUNT).cast("double").alias("amount"),
                                    "account_reference")), asc=False
        ).alias("transactions")
    )
    return totals.select(
        F.lit(phone).alias("phone_number"), name.alias("customer_name"), F.col("n").alias("total_transactions"),
        F.col("total").alias("total_amount"), newest.scalar().alias("transactions"),
    )


# -- customer risk -------------------------------------------------------------------------

def risk_score(count: Column, total: Column, largest: Column) -> Column:
    return (
        F.when((count >= 10) & (largest >= 50000), 0.9).when(largest >= 100000, 0.7)
        .when(total >= 250000, 0.6).otherwise(0.1)
    )


def risk_profile(payments: DataFrame) -> DataFrame:
    per_phone = payments.groupBy("phone_number").agg(
        F.count("*").alias("transaction_count"), F.sum("amount").alias("_total"), F.max("amount").alias("_max"),
    )
    score = risk_score(F.col("transaction_count"), F.col("_total"), F.col("_max"))
    return per_phone.select(
        "phone_number", "transaction_count", F.col("_total").cast("double").alias("total_amount"),
        F.col("_max").cast("double").alias("max_amount"), score.alias("fraud_score"),
        F.when(score >= 0.7, "high").otherwise("low").alias("risk_level"),
    )


def fraud_alerts(payments: DataFrame, severity: str | None = None) -> DataFrame:
    alerts = risk_profile(payments).filter("fraud_score >= 0.7").select(
        F.concat(F.lit("fraud-"), "phone_number").alias("alert_id"), "phone_number",
        F.lit("high").alias("severity"), "fraud_score",
    )
    return alerts if severity is None else alerts.filter(F.col("severity") == severity)


def customer_analytics(payments: DataFrame, phone: str) -> DataFrame:
    return risk_profile(payments.filter(F.col("phone_number") == P.normalize_ke_phone(F.lit(phone)))).drop("max_amount")


def analytics_summary(payments: DataFrame) -> DataFrame:
    return payments.agg(
        F.count("*").alias("transaction_count"),
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("total_amount"),
        F.countDistinct("phone_number").alias("unique_customers"),
    )


def api_daily_summary(payments: DataFrame, day: str) -> DataFrame:
    """One date; the busiest hour, the earlier one on a tie."""
    per_hour = payments.filter(P.day_of(payments) == F.lit(day).cast("date")).groupBy(
        F.hour("transaction_time").cast("bigint").alias("_hour"), "phone_number", "transaction_status"
    ).agg(F.count("*").alias("_n"), F.sum("amount").alias("_amount"))
    hours = per_hour.groupBy("_hour").agg(F.sum("_n").alias("_n"))
    peak = hours.agg(F.max_by("_hour", F.struct("_n", -F.col("_hour")))).scalar()
    n = F.sum("_n")
    return per_hour.agg(
        n.cast("bigint").alias("total_transactions"),
        F.sum("_amount").cast("double").alias("total_amount"),
        (F.sum("_amount").cast("double") / n).alias("average_amount"),
        F.countDistinct("phone_number").alias("unique_customers"),
        P.money_round(
            F.lit(100.0).cast("double") * F.sum(F.when(F.col("transaction_status") == "completed", F.col("_n")).otherwise(0)) / n
        ).alias("success_rate"),
    ).select(F.lit(day).cast("date").alias("date"), "*", peak.alias("peak_hour"))


def api_report(payments: DataFrame, start: str, end: str) -> DataFrame:
    """Range summary with mean day-over-day growth of payments and of customers.

    Growth of a day is relative to the previous day that has payments; the report shows the mean.
    """
    lower, upper = (F.lit(x).cast("date") for x in (start, end))
    kept = payments.filter(P.day_of(payments).between(lower, upper))
    days = kept.groupBy(P.day_of(kept).alias("day")).agg(
        F.count("*").alias("n"), F.countDistinct("phone_number").alias("customers")
    )
    by_day = Window.orderBy("day")  # one row per calendar day of the report

    def growth(c: str) -> Column:
        before = F.lag(c).over(by_day)
        return F.lit(100.0).cast("double") * (F.col(c) - before) / before

    trend = (
        days.select(growth("n").alias("g"), growth("customers").alias("c"))
        .agg(F.struct(F.avg("g").alias("g"), F.avg("c").alias("c"))).scalar()
    )
    return kept.agg(
        F.count("*").alias("total_transactions"), F.sum("amount").cast("double").alias("total_volume"),
        F.countDistinct("phone_number").alias("unique_customers"), P.exact_mean("amount").alias("average_transaction"),
    ).select(
        "*", P.money_round(trend["g"], 4).alias("daily_growth"), P.money_round(trend["c"], 4).alias("customer_growth"),
    )


def report_top_customers(payments: DataFrame, start: str, end: str, limit: int = 10) -> DataFrame:
    lower, upper = (F.lit(x).cast("date") for x in (start, end))
    return (
        payments.filter(P.day_of(payments).between(lower, upper)).groupBy("phone_number")
        .agg(F.count("*").alias("transaction_count"), F.sum("amount").cast("double").alias("total_amount"))
        .orderBy(F.desc("total_amount"), "phone_number").limit(limit)
    )
