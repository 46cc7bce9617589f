"""Customer, behaviour, anomaly, forecast and region analyses over landed payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import payments as P
from ..plans.skew import HOT_ROWS, exact_quantiles, profile_join, top_rows


def since(payments: DataFrame, as_of: Column, days: int) -> DataFrame:
    return P.from_time(payments, as_of - P.interval(days, "DAYS"))


# -- customers -----------------------------------------------------------------------------

def customer_day_metrics(payments: DataFrame, as_of: Column, days: int = 90, top: int | None = None,
                         per_customer: bool = False) -> DataFrame:
    """Spending per phone and day (or per phone) with a value score; ``top`` lists only the largest by sum."""
    keys = ["phone_number"] if per_customer else ["phone_number", "last_transaction_date"]
    amount = F.col("amount")
    grouped = (
        since(payments, as_of, days).withColumn("last_transaction_date", P.day_of(payments)).groupBy(*keys)
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum(amount).cast("double").alias("total_amount"),
            P.exact_mean(amount).alias("avg_amount"),
            F.max(amount).cast("double").alias("max_amount"),
            F.min(amount).cast("double").alias("min_amount"),
            F.coalesce(F.stddev_samp(amount.cast("double")), F.lit(0.0)).alias("_std"),
        )
    )
    if top is not None:
        grouped = top_rows(grouped, "total_amount", keys, top)
    names = ("total_amount", "transaction_count", "avg_amount")
    peak = grouped.agg(F.struct(*[F.max(c).alias(c) for c in names])).scalar()
    score = (
        F.col("total_amount") / peak["total_amount"] * 0.5
        + F.col("transaction_count") / peak["transaction_count"] * 0.3
        + F.col("avg_amount") / peak["avg_amount"] * 0.2
    )
    return grouped.select(
        *keys, "transaction_count", "total_amount", "avg_amount", "max_amount", "min_amount",
        P.money_round("_std", 4).alias("std_amount"),
        (F.col("total_amount") / F.col("transaction_count")).alias("avg_transaction_value"),
        (F.col("transaction_count") / F.lit(float(days)).cast("double")).alias("transaction_frequency"),
        P.money_round(F.col("_std") / (F.col("avg_amount") + 1), 4).alias("volatility"),
        P.money_round(score, 4).alias("customer_value_score"),
    )


def segment_stats(segmented: DataFrame) -> DataFrame:
    """Statistics per segment name."""
    def two(c: Column) -> Column:
        return P.money_round(c, 2)

    stats = segmented.groupBy("segment_name").agg(
        F.count("*").alias("customers"),
        two(F.avg("transaction_count")).alias("mean_count"),
        two(F.avg("total_amount")).alias("mean_total"),
        two(F.stddev_samp("total_amount")).alias("std_total"),
        two(F.avg("avg_amount")).alias("mean_avg"),
        two(F.avg("customer_value_score")).alias("mean_score"),
    )
    medians = exact_quantiles(segmented, "total_amount", {"_median": 0.5}, by=["segment_name"])
    return stats.join(medians, "segment_name").withColumn("median_total", two(F.col("_median"))).drop("_median")


# -- behaviour -----------------------------------------------------------------------------

def _phone_hours(payments: DataFrame, as_of: Column, days: int) -> DataFrame:
    return since(payments, as_of, days).groupBy(
        "phone_number", P.trunc_ts("hour", "transaction_time").alias("transaction_hour")
    ).agg(F.count("*").alias("transaction_count"), F.sum("amount").alias("total_amount"))


def peak_hours(payments: DataFrame, as_of: Column, days: int = 7, top: int = 3) -> DataFrame:
    """Busiest hours of the day, with the mean count per phone and hour."""
    hours = _phone_hours(payments, as_of, days)
    mean = hours.agg(P.money_round(F.avg("transaction_count"), 2)).scalar()
    return (
        hours.groupBy(F.hour("transaction_hour").cast("bigint").alias("hour_of_day"))
        .agg(F.sum("transaction_count").alias("transaction_count"))
        .orderBy(F.desc("transaction_count"), "hour_of_day").limit(top)
        .withColumn("avg_transaction_per_hour", mean)
    )


def daily_pattern(payments: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Totals per day of week, Monday being 0."""
    return _phone_hours(payments, as_of, days).groupBy(
        F.weekday("transaction_hour").cast("bigint").alias("day_of_week")
    ).agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_amount").cast("double").alias("total_amount"),
        F.countDistinct("phone_number").alias("unique_customers"),
    )


# -- anomalies -----------------------------------------------------------------------------

def customer_stats(payments: DataFrame) -> DataFrame:
    """Mean and deviation per phone, two decimals; a single payment has no deviation."""
    return payments.groupBy("phone_number").agg(
        P.money_round(P.exact_mean("amount")).alias("mean_amount"),
        P.money_round(F.stddev_samp(F.col("amount").cast("double"))).alias("std_amount"),
        F.count("*").alias("transaction_count"),
    )


def customer_stats_join(payments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    rows = payments.filter(F.col("phone_number").isNotNull())
    return profile_join(rows, customer_stats(rows), ["phone_number"], "transaction_count", "transaction_id", hot_rows)


def zscores(payments: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    rows = customer_stats_join(since(payments, as_of, days))
    amount = F.col("amount").cast("double")
    return rows.withColumn("amount_zscore", F.abs(amount - F.col("mean_amount")) / (F.col("std_amount") + 1))


def zscore_anomaly(payments: DataFrame, as_of: Column, days: int = 30, threshold: float = 2.5) -> DataFrame:
    amount = F.col("amount").cast("double")
    return zscores(payments, as_of, days).filter(F.col("amount_zscore") > threshold).select(
        "transaction_id", "phone_number", amount.alias("amount"), P.money_round("amount_zscore", 4).alias("amount_zscore"),
        F.when(amount > F.col("mean_amount"), "Unusually High").otherwise("Unusually Low").alias("anomaly_type"),
    )


def zscore_first(payments: DataFrame, as_of: Column, days: int = 30, threshold: float = 2.5, limit: int = 100) -> DataFrame:
    """The report's short list: the strongest deviations."""
    return zscore_anomaly(payments, as_of, days, threshold).orderBy(F.desc("amount_zscore"), "transaction_id").limit(limit)


def zscore_summary(payments: DataFrame, as_of: Column, days: int = 30, threshold: float = 2.5) -> DataFrame:
    amount, hit = F.col("amount").cast("double"), F.coalesce(F.col("amount_zscore") > threshold, F.lit(False))
    return zscores(payments, as_of, days).agg(
        F.count_if(hit).alias("total_anomalies"),
        P.money_round(F.try_divide(F.count_if(hit) * F.lit(100.0).cast("double"), F.count("*"))).alias("anomaly_percentage"),
        F.count_if(hit & (amount > F.col("mean_amount"))).alias("high"),
        F.count_if(hit & (amount < F.col("mean_amount"))).alias("low"),
    )


# -- forecast ------------------------------------------------------------------------------

def daily_volume(payments: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    return since(payments, as_of, days).groupBy(P.day_of(payments).alias("transaction_date")).agg(
        F.count("*").alias("transaction_count"), F.sum("amount").cast("double").alias("daily_volume")
    )


def moving_average(payments: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Means over 7 and 14 rows, null until the frame is full. One row per day, hence one task."""
    daily = daily_volume(payments, as_of, days)

    def rolling(n: int) -> Column:
        frame = Window.orderBy("transaction_date").rowsBetween(-(n - 1), 0)
        mean = F.sum("transaction_count").over(frame) / F.lit(float(n)).cast("double")
        return F.when(F.count("*").over(frame) == n, mean)

    return daily.select("*", rolling(7).alias("ma_7"), rolling(14).alias("ma_14"))


def trend_forecast(payments: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Last seven days against the seven before; no row with fewer than seven days."""
    ranked = moving_average(payments, as_of, days).withColumn(
        "_back", F.row_number().over(Window.orderBy(F.desc("transaction_date")))
    )
    recent = F.avg(F.when(F.col("_back") <= 7, F.col("transaction_count")))
    previous = F.avg(F.when(F.col("_back").between(8, 14), F.col("transaction_count")))
    return ranked.agg(
        F.count("*").alias("_days"), recent.alias("_recent"), previous.alias("_previous"),
        F.max(F.when(F.col("_back") == 1, F.col("ma_7"))).alias("ma_7"),
        F.max(F.when(F.col("_back") == 1, F.col("ma_14"))).alias("ma_14"),
    ).filter("_days >= 7").select(
        F.when(F.col("_recent") > F.col("_previous"), "up").otherwise("down").alias("current_trend"),
        F.floor("_recent").alias("next_day_forecast"), F.floor("_recent").alias("recent_average"),
        F.lit("Medium").alias("forecast_confidence"), "ma_7", "ma_14",
    )


def volume_deviation(payments: DataFrame, as_of: Column, days: int = 90, threshold: float = 20.0) -> DataFrame:
    """Daily count against the mean of the seven rows before it."""
    daily = daily_volume(payments, as_of, days)
    before = Window.orderBy("transaction_date").rowsBetween(-7, -1)
    expected = F.when(
        F.count("*").over(before) == 7, F.sum("transaction_count").over(before) / F.lit(7.0).cast("double")
    )
    actual = F.col("transaction_count")
    deviation = F.when(F.col("expected") > 0, F.abs(actual - F.col("expected")) / F.col("expected") * 100).otherwise(0.0)
    return (
        daily.withColumn("expected", expected).filter("expected is not null")
        .select("transaction_date", actual.alias("actual"), P.money_round("expected", 4).alias("expected"),
                P.money_round(deviation, 4).alias("deviation_percent"), (deviation > threshold).alias("alert"))
    )


# -- regions -------------------------------------------------------------------------------

def regional_analysis(payments: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Shares per region. The regions come from a fixed lookup, so the totals fit one task."""
    grouped = since(payments, as_of, days).filter(F.col("region").isNotNull()).groupBy("region").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").cast("double").alias("total_amount"),
        P.exact_mean("amount").alias("avg_amount"),
        F.countDistinct("phone_number").alias("unique_customers"),
    )
    everything = Window.partitionBy()

    def share(c: str) -> Column:
        return P.money_round(F.col(c) / F.sum(c).over(everything) * 100)

    rank = F.row_number().over(Window.orderBy(F.desc("total_amount"), "region"))
    return grouped.select(
        "*", share("transaction_count").alias("transaction_percentage"), share("total_amount").alias("volume_percentage"),
        P.money_round(F.stddev_samp("avg_amount").over(everything)).alias("regional_variance"),
        rank.cast("bigint").alias("volume_rank"),
    )


#: Days that each section of the report looks back.
REPORT_DAYS = {"behaviour": 7, "anomalies": 30, "forecast": 90, "regions": 30}


def analytics_report(payments: DataFrame, regional: DataFrame, as_of, segmented: DataFrame, days: dict[str, int] | None = None) -> DataFrame:
    """All analyses as (section, metric, value) rows, with the time that the report is for."""
    days = REPORT_DAYS | (days or {})

    def rows(df: DataFrame, section: str, label: Column, metrics: list[str]) -> DataFrame:
        pairs = F.explode(F.map_from_arrays(
            F.array(*[F.concat_ws(".", label, F.lit(m)) for m in metrics]),
            F.array(*[F.col(m).cast("string") for m in metrics]),
        ))
        return df.select(F.lit(section).alias("section"), pairs.alias("metric", "value"))

    regions = regional_analysis(regional, as_of(), days["regions"])
    top = regions.filter("volume_rank = 1").select(F.col("region").alias("top_region"), "regional_variance")
    when = payments.sparkSession.range(1).select(F.date_format(as_of(), "yyyy-MM-dd HH:mm:ss").alias("as_of"))
    parts = [
        rows(when, "report", F.lit("all"), ["as_of"]),
        rows(segment_stats(segmented), "segmentation", F.col("segment_name"),
             ["customers", "mean_count", "mean_total", "median_total", "std_total", "mean_avg", "mean_score"]),
        rows(peak_hours(payments, as_of(), days["behaviour"]), "behaviour", F.concat(F.lit("hour_"), "hour_of_day"),
             ["transaction_count", "avg_transaction_per_hour"]),
        rows(daily_pattern(payments, as_of(), days["behaviour"]), "behaviour", F.concat(F.lit("day_"), "day_of_week"),
             ["transaction_count", "total_amount", "unique_customers"]),
        rows(zscore_summary(payments, as_of(), days["anomalies"]), "anomalies", F.lit("all"),
             ["total_anomalies", "anomaly_percentage", "high", "low"]),
        rows(trend_forecast(payments, as_of(), days["forecast"]), "forecast", F.lit("all"),
             ["current_trend", "next_day_forecast", "recent_average", "forecast_confidence", "ma_7", "ma_14"]),
        rows(regions, "regions", F.col("region"),
             ["transaction_count", "total_amount", "avg_amount", "unique_customers", "transaction_percentage", "volume_percentage", "volume_rank"]),
        rows(top, "regions", F.lit("all"), ["top_region", "regional_variance"]),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
