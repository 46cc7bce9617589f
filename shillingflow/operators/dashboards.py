"""Dashboard panels over typed confirmations, staged raw events and marts.

``as_of`` stands for the wall clock and may be a literal or a scalar subquery. Ranges are
filtered on the date first, so a table partitioned by ``transaction_date`` is pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payments as P
from ..plans.skew import HOT_ROWS, exact_quantiles, profile_join
from ..sources.history import History
from . import marts, staging

AMOUNT = "transaction_amount"
TIME = "transaction_timestamp"
PHONE = "customer_phone_number"


def recent(tx: DataFrame, as_of: Column, n: int, unit: str, accounts: list[str] | None = None) -> DataFrame:
    """Rows of the last ``n`` units up to ``as_of``, optionally for some accounts."""
    lower = as_of - P.interval(n, unit)
    return tx.filter(
        (F.col("transaction_date") >= F.to_date(lower)) & (F.col("transaction_date") <= F.to_date(as_of))
        & F.col(TIME).between(lower, as_of) & P.account_filter(accounts)
    )


def recent_days(df: DataFrame, as_of: Column, days: int, accounts: list[str] | None = None) -> DataFrame:
    lower = F.to_date(as_of) - P.interval(days, "DAYS")
    return df.filter((F.col("transaction_date") >= F.to_date(lower)) & P.account_filter(accounts))


def received_within(raw: DataFrame, as_of: Column, n: int, unit: str) -> DataFrame:
    return P.arrived_from(raw, as_of - P.interval(n, unit), as_of)


def today(tx: DataFrame, as_of: Column, accounts: list[str] | None = None) -> DataFrame:
    return tx.filter((F.col("transaction_date") == F.to_date(as_of)) & P.account_filter(accounts))


def total(c: str = AMOUNT) -> Column:
    return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))


# -- executive -----------------------------------------------------------------------------

def value_today(tx, as_of, accounts=None):
    return today(tx, as_of, accounts).agg(total().alias("value"))


def txns_today(tx, as_of, accounts=None):
    return today(tx, as_of, accounts).agg(F.count("*").alias("value"))


def customers_today(tx, as_of, accounts=None):
    return today(tx, as_of, accounts).agg(F.countDistinct(PHONE).alias("value"))


def avg_ticket_today(tx, as_of, accounts=None):
    return today(tx, as_of, accounts).agg(F.coalesce(P.exact_mean(AMOUNT), F.lit(0.0)).alias("value"))


def _days(tx, lower, upper):
    """The payments of whole days, so that hours inside are complete and other days are not read."""
    return tx.filter(F.col("transaction_date").between(F.to_date(lower), F.to_date(upper)))


def value_by_hour(hourly, tx, as_of, accounts=None, days=7):
    """Mart totals for hours that have a matching payment, each hour once.

    Without a stored mart (``hourly`` is ``None``) the hours are computed from the days in question."""
    lower = as_of - P.interval(days, "DAYS")
    if hourly is None:
        hourly = marts.hourly_volumes(_days(tx, lower, as_of + P.interval(1, "HOURS")))
    hours = hourly.filter(F.col("hour_bucket").between(lower, as_of))
    if accounts is not None:
        matching = _days(tx, lower, as_of + P.interval(1, "HOURS")).filter(
            F.col(TIME).between(lower, as_of + P.interval(1, "HOURS")) & P.account_filter(accounts)
        ).select(P.trunc_ts("hour", TIME).alias("hour_bucket")).distinct()
        hours = hours.join(matching, "hour_bucket", "left_semi")
    return hours.select(
        F.col("hour_bucket").alias("time"), F.col("total_amount").alias("value_kes"),
        F.col("transaction_count").alias("transactions"),
    )


def value_by_hour_as_written(tx, as_of, days=7):
    """The panel as first written: the mart row counts once per payment of its hour.

    That product needs no join to the rows: a mart row repeated ``n`` times sums to ``n`` times
    its value, and ``n`` is the hour's own payment count.
    """
    lower = as_of - P.interval(days, "DAYS")
    per_hour = (
        _days(tx, lower, as_of + P.interval(1, "HOURS")).groupBy(P.trunc_ts("hour", TIME).alias("time"))
        .agg(F.sum(AMOUNT).alias("_value"), F.count("*").alias("_n"))
        .filter(F.col("time").between(lower, as_of))
    )
    return per_hour.select(
        "time", (F.col("_value") * F.col("_n")).cast("double").alias("value_kes"),
        (F.col("_n") * F.col("_n")).alias("transactions"),
    )


def value_mix(tx, as_of, accounts=None, days=7):
    return recent(tx, as_of, days, "DAYS", accounts).groupBy(F.col("amount_category").alias("band")).agg(
        total().alias("value")
    )


def top_accounts(heatmap, as_of, days=7, limit=15):
    return (
        recent_days(heatmap, as_of, days)
        .groupBy(F.coalesce("account_reference", F.lit("Unassigned")).alias("account_reference"))
        .agg(
            F.sum("transaction_count").alias("transactions"),
            F.sum("total_amount").alias("_value"),
            F.avg(F.try_divide("total_amount", "transaction_count")).alias("_ticket"),
        )
        .select("account_reference", "transactions", P.money_round("_value").alias("value_kes"),
                P.money_round("_ticket").alias("avg_ticket"))
        .orderBy(F.desc("value_kes"), "account_reference").limit(limit)
    )


def daily_trend(daily, as_of, accounts=None, days=14):
    return recent_days(daily, as_of, days, accounts).groupBy(
        F.col("transaction_date").cast("string").alias("day")
    ).agg(P.money_round(F.sum("total_transaction_value")).alias("value_kes"))


# -- live operations -----------------------------------------------------------------------

def throughput(tx, as_of, accounts=None, minutes=5):
    return recent(tx, as_of, minutes, "MINUTES", accounts).agg(F.count("*").alias("value"))


def freshness_minutes(raw, as_of):
    gap = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.max("received_at").cast("timestamp"))
    return raw.agg(F.coalesce(gap / F.lit(60.0).cast("double"), F.lit(0.0)).alias("value"))


def _repeated_ids(raw):
    return (
        raw.filter(F.col("transaction_id").isNotNull()).groupBy("transaction_id")
        .agg(F.count("*").alias("duplicate_count"), F.min("received_at").alias("first_seen"),
             F.max("received_at").alias("last_seen"))
        .filter("duplicate_count > 1")
    )


def duplicate_ids(raw):
    return _repeated_ids(raw).agg(F.count("*").alias("value"))


def raw_loaded(raw, as_of, hours=24):
    return received_within(raw, as_of, hours, "HOURS").agg(F.count("*").alias("value"))


def ingest_rate(raw, as_of, hours=6):
    return received_within(raw, as_of, hours, "HOURS").groupBy(
        P.trunc_ts("minute", "received_at").alias("time")
    ).agg(F.count("*").alias("raw_events"))


def value_per_minute(tx, as_of, accounts=None, hours=6):
    return recent(tx, as_of, hours, "HOURS", accounts).groupBy(
        P.trunc_ts("minute", TIME).alias("time")
    ).agg(total().alias("value_kes"))


def recent_confirmations(tx, as_of, accounts=None, hours=6, limit=50):
    return (
        recent(tx, as_of, hours, "HOURS", accounts)
        .select(TIME, "transaction_id", PHONE, "account_reference",
                F.col(AMOUNT).cast("double").alias(AMOUNT), "amount_category", "loaded_at")
        .orderBy(F.desc(TIME), "transaction_id").limit(limit)
    )


# -- fraud and risk ------------------------------------------------------------------------

def critical_events(tx, as_of, accounts=None, hours=24):
    return recent(tx, as_of, hours, "HOURS", accounts).filter(F.col(AMOUNT) >= P.HIGH_AMOUNT).agg(
        F.count("*").alias("value")
    )


def night_events(tx, as_of, accounts=None, hours=24):
    return recent(tx, as_of, hours, "HOURS", accounts).filter(P.is_night("transaction_hour")).agg(
        F.count("*").alias("value")
    )


def velocity_customers(tx, as_of, accounts=None, hours=1, at_least=5):
    return (
        recent(tx, as_of, hours, "HOURS", accounts).groupBy(PHONE).count()
        .filter(F.col("count") >= at_least).agg(F.count("*").alias("value"))
    )


SEQUENCE = "transaction_sequence_per_customer"


def recent_sequenced(tx: DataFrame, as_of: Column, n: int, unit: str, accounts: list[str] | None = None,
                     hot_rows: int = HOT_ROWS, history: History | None = None) -> DataFrame:
    """Recent rows with their number in the customer's whole history.

    Every row has a customer, as staged rows do. A saved staging table already holds the number. Without it, only the recent rows are
    numbered; what came before is a count per customer. With ``history`` that count comes from its stored
    totals and the first day's rows, so nothing older is read (``as_of`` must then be a literal).
    """
    if SEQUENCE in tx.columns:
        return recent(tx, as_of, n, unit, accounts)
    lower = as_of - P.interval(n, unit)
    numbered = staging.with_sequence(recent(tx, as_of, n, unit), hot_rows)
    before = F.col(TIME).isNull() | (F.col(TIME) < lower)
    if history is not None:
        return _numbered_from(tx, numbered, history, lower, accounts, hot_rows)
    history = (
        tx.filter(F.col(TIME).isNull() | (F.col(TIME) <= as_of)).groupBy(PHONE)
        .agg(F.count_if(before).alias("_earlier"), F.count_if(~before).alias("_rows"))
        .filter("_rows > 0")
    )
    rows = profile_join(numbered, history, [PHONE], "_rows", "transaction_id", hot_rows)
    return (
        rows.withColumn(SEQUENCE, F.col(SEQUENCE) + F.coalesce("_earlier", F.lit(0))).drop("_earlier", "_rows")
        .filter(P.account_filter(accounts))
    )


def _numbered_from(tx: DataFrame, numbered: DataFrame, history: History, lower: Column, accounts: list[str] | None,
                   hot_rows: int) -> DataFrame:
    """Adds to the numbers of recent rows what the stored totals and the first day's earlier rows count."""
    first = tx.sparkSession.range(1).select(F.to_date(lower)).first()[0]
    same_day = tx.filter((F.col("transaction_date") == F.lit(first)) & (F.col(TIME) < lower)).groupBy(PHONE).agg(F.count("*").alias("rows"))
    now = numbered.groupBy(PHONE).agg(F.count("*").alias("_rows")).withColumnRenamed(PHONE, "_phone")
    earlier = history.before(first).unionByName(same_day).groupBy(PHONE).agg(F.sum("rows").alias("_earlier"))
    known = now.join(earlier, F.col("_phone").eqNullSafe(F.col(PHONE)), "left").select(F.col("_phone").alias(PHONE), "_earlier", "_rows")
    rows = profile_join(numbered, known, [PHONE], "_rows", "transaction_id", hot_rows)
    return rows.withColumn(SEQUENCE, F.col(SEQUENCE) + F.coalesce("_earlier", F.lit(0))).drop("_earlier", "_rows").filter(P.account_filter(accounts))


def with_risk(sequenced):
    return sequenced.withColumn("risk_bucket", P.risk_bucket())


def risk_exposure(tx, as_of, accounts=None, hours=24, history=None):
    return with_risk(recent_sequenced(tx, as_of, hours, "HOURS", accounts, history=history)).filter("risk_bucket <> 'normal'").agg(
        total().alias("value")
    )


def risk_mix(tx, as_of, accounts=None, hours=24, history=None):
    return with_risk(recent_sequenced(tx, as_of, hours, "HOURS", accounts, history=history)).groupBy("risk_bucket").agg(
        F.count("*").alias("events")
    )


def risk_over_time(tx, as_of, accounts=None, hours=24, history=None):
    rows = with_risk(recent_sequenced(tx, as_of, hours, "HOURS", accounts, history=history))
    return rows.groupBy(P.trunc_ts("hour", TIME).alias("time")).agg(
        *[F.count_if(F.col("risk_bucket") == b).alias(b) for b in ("critical", "elevated", "velocity")]
    )


def risk_review_list(tx, as_of, accounts=None, days=7, limit=50, history=None):
    rows = with_risk(recent_sequenced(tx, as_of, days, "DAYS", accounts, history=history)).filter("risk_bucket <> 'normal'")
    return (
        rows.groupBy(PHONE).agg(
            F.count("*").alias("events"),
            F.sum(AMOUNT).cast("double").alias("value_kes"),
            F.max(AMOUNT).cast("double").alias("largest_transaction"),
            F.max(TIME).alias("latest_seen"),
            # three possible reasons, so the set stays tiny
            F.array_join(F.array_sort(F.collect_set("risk_bucket")), ", ").alias("risk_reasons"),
        )
        .orderBy(F.desc("value_kes"), PHONE).limit(limit)
    )


# -- customers -----------------------------------------------------------------------------

def customers_in_range(tx, as_of, accounts=None, days=30):
    return recent(tx, as_of, days, "DAYS", accounts).agg(F.countDistinct(PHONE).alias("value"))


def _customer_totals(tx, as_of, accounts, days):
    return recent(tx, as_of, days, "DAYS", accounts).groupBy(PHONE).agg(
        F.count("*").alias("txns"), F.sum(AMOUNT).alias("value_kes")
    )


def repeat_rate(tx, as_of, accounts=None, days=30):
    repeat = F.count_if(F.col("txns") > 1) * F.lit(100.0).cast("double")
    return _customer_totals(tx, as_of, accounts, days).agg(
        F.coalesce(F.try_divide(repeat, F.count("*")), F.lit(0.0)).alias("value")
    )


def median_value(tx, as_of, accounts=None, days=30):
    median = exact_quantiles(_customer_totals(tx, as_of, accounts, days), "value_kes", {"q": 0.5})
    return median.agg(F.coalesce(P.money_round(F.max("q"), 4), F.lit(0.0)).alias("value"))


def top_customer_share(tx, as_of, accounts=None, days=30):
    top = F.max("value_kes").cast("double") * 100
    return _customer_totals(tx, as_of, accounts, days).agg(
        F.coalesce(P.money_round(F.try_divide(top, F.sum("value_kes").cast("double")), 4), F.lit(0.0)).alias("value")
    )


def timing_pattern(tx, as_of, accounts=None, days=30):
    return recent(tx, as_of, days, "DAYS", accounts).groupBy(
        P.day_period("transaction_hour").alias("period")
    ).agg(F.count("*").alias("transactions"))


def value_bands(tx, as_of, accounts=None, days=30):
    return _customer_totals(tx, as_of, accounts, days).groupBy(
        P.value_band("value_kes").alias("value_band")
    ).agg(F.count("*").alias("customers"))


def top_customers(tx, as_of, accounts=None, days=30, limit=50):
    return (
        recent(tx, as_of, days, "DAYS", accounts).groupBy(PHONE).agg(
            F.count("*").alias("transactions"),
            F.sum(AMOUNT).cast("double").alias("value_kes"),
            P.money_round(P.exact_mean(AMOUNT)).alias("avg_ticket"),
            F.max(TIME).alias("latest_transaction"),
        )
        .orderBy(F.desc("value_kes"), PHONE).limit(limit)
    )


# -- data quality --------------------------------------------------------------------------

def missing_text(raw, c):
    return raw.agg(F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias("value"))


def invalid_amount(raw):
    amount = F.col("amount").try_cast("decimal(12,2)")
    return raw.agg(F.count_if(amount.isNull() | (amount < 0)).alias("value"))


def model_freshness(mart, as_of, built_at="created_at"):
    """Minutes since the mart was built; the build time is a column of the saved mart."""
    gap = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.max(built_at).cast("timestamp"))
    return mart.agg(F.coalesce(gap / F.lit(60.0).cast("double"), F.lit(0.0)).alias("value"))


def raw_vs_staged(raw, staged, as_of, days=7):
    raw_counts = received_within(raw, as_of, days, "DAYS").groupBy(
        P.trunc_ts("hour", "received_at").alias("time")
    ).agg(F.count("*").alias("raw_events"))
    staged_counts = recent(staged, as_of, days, "DAYS").groupBy(
        P.trunc_ts("hour", TIME).alias("time")
    ).agg(F.count("*").alias("staged_events"))
    return raw_counts.join(staged_counts, "time", "full_outer").select(
        "time", F.coalesce("raw_events", F.lit(0)).alias("raw_events"),
        F.coalesce("staged_events", F.lit(0)).alias("staged_events"),
    )


def completeness(staged, as_of, days=14):
    return recent_days(staged, as_of, days).groupBy("transaction_date").agg(
        F.count("*").alias("staged_transactions"),
        F.count_if(F.col(PHONE).isNull()).alias("missing_phone"),
        F.count_if(F.col(AMOUNT).isNull()).alias("missing_amount"),
        F.count_if(F.col("account_reference").isNull()).alias("missing_reference"),
    )


def duplicates(raw, limit=50):
    return _repeated_ids(raw).orderBy(F.desc("duplicate_count"), F.desc("last_seen"), "transaction_id").limit(limit)
