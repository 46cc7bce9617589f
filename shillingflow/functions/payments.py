"""Payment column expressions: parsing, normalising, bucketing.

All are plain Catalyst expressions, so the same function serves batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Amount cut points, anomaly limits and scores.
HIGH_AMOUNT = 100000
MEDIUM_AMOUNT = 10000
MAX_SINGLE = 500000
MIN_SINGLE = 1

# Four-digit phone prefix to region.
PREFIX_REGIONS = {
    "0700": "Nairobi", "0701": "Nairobi", "0702": "Nairobi", "0703": "Nairobi",
    "0704": "Central", "0705": "Coast", "0706": "Coast", "0707": "Rift Valley",
    "0708": "Western", "0709": "Western", "0710": "Central", "0711": "Eastern",
    "0712": "Nyanza", "0713": "Nairobi", "0714": "Nairobi", "0715": "Western",
    "0716": "Coast", "0717": "Nairobi", "0718": "Central", "0719": "Nairobi",
    "0720": "Nairobi", "0721": "Nairobi", "0722": "Nairobi", "0723": "Nairobi",
    "0724": "Central", "0725": "Eastern", "0726": "Western", "0727": "Rift Valley",
    "0728": "Nyanza", "0729": "Coast", "0740": "Nairobi", "0741": "Central",
    "0742": "Rift Valley", "0743": "Western", "0744": "Nyanza", "0745": "Coast",
    "0746": "Eastern", "0748": "Nairobi", "0749": "Central", "0750": "Nairobi",
    "0751": "Rift Valley", "0752": "Western", "0753": "Nyanza", "0754": "Coast",
    "0755": "Eastern", "0756": "Nairobi", "0757": "Central", "0758": "Nairobi",
    "0759": "Rift Valley", "0760": "Western", "0761": "Nyanza", "0762": "Coast",
    "0763": "Eastern", "0764": "Nairobi", "0765": "Central", "0768": "Nairobi",
    "0769": "Nairobi", "0771": "Nairobi", "0772": "Nairobi", "0773": "Nairobi",
    "0774": "Nairobi", "0775": "Nairobi", "0776": "Nairobi", "0777": "Nairobi",
    "0778": "Nairobi", "0779": "Nairobi", "0780": "Nairobi", "0781": "Nairobi",
    "0782": "Nairobi", "0783": "Nairobi",
}

# Region to risk factor; regions not listed get the default.
REGION_RISK = {
    "Nairobi": 0.3, "Central": 0.2, "Coast": 0.25, "Western": 0.15, "Eastern": 0.2,
    "Rift Valley": 0.18, "Nyanza": 0.17, "Unknown": 0.5,
}
DEFAULT_REGION_RISK = 0.3


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def ntz(c) -> Column:
    return col(c).cast("timestamp_ntz")


def trunc_ts(unit: str, c) -> Column:
    return F.date_trunc(unit, col(c)).cast("timestamp_ntz")


def money_round(c, digits: int = 2) -> Column:
    """Half-up rounding of a double, done in decimal so that ties are exact."""
    return F.round(col(c).cast("decimal(24,6)"), digits).cast("double")


def exact_mean(amount) -> Column:
    """Mean of a decimal column as exact sum over count; independent of row order."""
    amount = col(amount)
    return F.sum(amount).cast("double") / F.count(amount)


# -- parsing -------------------------------------------------------------------------------

def txn_time(c) -> Column:
    """Compact ``yyyyMMddHHmmss`` first, then ISO-8601; empty or unreadable text gives null.

    The text appears only twice: filters pushed below a projection repeat the whole expression.
    """
    text = col(c)
    compact = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))
    iso = F.regexp_extract(text, r"^\d{4}-\d{2}-\d{2}.*$", 0).try_cast("timestamp")
    return F.coalesce(compact, iso).cast("timestamp_ntz")


def txn_time_unreadable(c) -> Column:
    return blank_to_null(c).isNotNull() & txn_time(c).isNull()


def iso_dow(c) -> Column:
    return F.weekday(col(c)) + 1


# -- phones --------------------------------------------------------------------------------

def standardize_phone(c) -> Column:
    """Lenient: trims, drops one leading plus, turns a leading zero into the country code."""
    return F.regexp_replace(F.regexp_replace(F.trim(col(c)), r"^\+", ""), "^0", "254")


def normalize_ke_phone(c) -> Column:
    """Strict: as the lenient form but without blanks and hyphens; null unless ``254`` + 9 digits."""
    phone = standardize_phone(F.translate(F.trim(col(c)), " -", ""))
    return F.when(phone.rlike(r"^254[0-9]{9}$"), phone)


def phone_prefix(c: str) -> Column:
    """Local four-digit prefix of either a ``07..`` or a ``254..`` number."""
    return F.expr(f"CASE WHEN startswith({c}, '254') THEN concat('0', substr({c}, 4, 3)) ELSE substr({c}, 1, 4) END")


def with_region(df: DataFrame, phone: str = "phone_number", out: str = "region") -> DataFrame:
    """Region by phone prefix. The lookup has 70 fixed rows, hence the broadcast."""
    values = ", ".join(f"('{prefix}', '{region}')" for prefix, region in PREFIX_REGIONS.items())
    lookup = df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(_prefix, _region)")
    return (
        df.withColumn("_prefix", phone_prefix(phone))
        .join(F.broadcast(lookup), "_prefix", "left")
        .withColumn(out, F.coalesce("_region", F.lit("Unknown")))
        .drop("_prefix", "_region")
    )


def region_risk_sql(c: str) -> str:
    pairs = ", ".join(f"'{region}', {factor}D" for region, factor in REGION_RISK.items())
    return f"coalesce(try_element_at(map({pairs}), {c}), {DEFAULT_REGION_RISK}D)"


def region_risk(c: str) -> Column:
    return F.expr(region_risk_sql(c))


# -- buckets -------------------------------------------------------------------------------

def amount_category_sql(c: str) -> str:
    """A missing amount counts as zero."""
    return (
        f"CASE WHEN coalesce({c}, 0) >= {HIGH_AMOUNT} THEN 'high' "
        f"WHEN coalesce({c}, 0) >= {MEDIUM_AMOUNT} THEN 'medium' ELSE 'low' END"
    )


def amount_category(c) -> Column:
    if isinstance(c, str):
        return F.expr(amount_category_sql(c))
    amount = F.coalesce(c, F.lit(0))
    return (
        F.when(amount >= HIGH_AMOUNT, "high").when(amount >= MEDIUM_AMOUNT, "medium").otherwise("low")
    )


def is_night(hour) -> Column:
    return (col(hour) < 6) | (col(hour) >= 22)


def risk_bucket(amount="transaction_amount", hour="transaction_hour",
                sequence="transaction_sequence_per_customer") -> Column:
    return (
        F.when(col(amount) >= HIGH_AMOUNT, "critical")
        .when(is_night(hour), "elevated")
        .when(col(sequence) >= 10, "velocity")
        .otherwise("normal")
    )


def day_period(hour) -> Column:
    hour = col(hour)
    return (
        F.when((hour >= 6) & (hour < 12), "Morning")
        .when((hour >= 12) & (hour < 18), "Afternoon")
        .otherwise("Evening/Night")
    )


def value_band(total) -> Column:
    total = col(total)
    return (
        F.when(total >= 100000, "Enterprise")
        .when(total >= 25000, "High Value")
        .when(total >= 5000, "Core")
        .otherwise("Long Tail")
    )


def anomaly_columns(amount, max_single: float = MAX_SINGLE, min_single: float = MIN_SINGLE) -> dict[str, Column]:
    amount = F.coalesce(col(amount).cast("double"), F.lit(0.0))
    large, small = amount > max_single, amount < min_single
    return {
        "anomaly_flag": large | small,
        "anomaly_type": F.when(large, "unusually_large").when(small, "invalid_amount"),
        "risk_score": F.when(large, 85.0).when(small, 100.0)
        .otherwise(F.lit(10.0) + amount / F.lit(float(max_single)) * F.lit(30.0)),
    }


def customer_name(first="FirstName", middle="MiddleName", last="LastName") -> Column:
    return F.concat_ws(" ", *[blank_to_null(F.trim(col(c))) for c in (first, middle, last)])


# -- filters -------------------------------------------------------------------------------

def account_filter(accounts: list[str] | None, c: str = "account_reference") -> Column:
    """``None`` keeps every account; otherwise rows without one count as ``Unassigned``."""
    if accounts is None:
        return F.lit(True)
    return F.coalesce(F.col(c), F.lit("Unassigned")).isin(accounts)


def day_of(df: DataFrame, time: str = "transaction_time") -> Column:
    """The stored date where there is one: partitions and scan filters work on it."""
    return F.col("transaction_date") if "transaction_date" in df.columns else F.to_date(time)


def from_time(df: DataFrame, lower: Column, time: str = "transaction_time") -> DataFrame:
    """Rows at or after ``lower``, by date first."""
    return df.filter((day_of(df, time) >= F.to_date(lower)) & (F.col(time) >= lower))


def arrived_from(df: DataFrame, lower: Column, upper: Column | None = None, time: str = "received_at") -> DataFrame:
    """Rows that arrived at or after ``lower`` (and up to ``upper``), by arrival date first where it is stored."""
    if "received_date" in df.columns:
        df = df.filter(F.col("received_date") >= F.to_date(lower))
        df = df if upper is None else df.filter(F.col("received_date") <= F.to_date(upper))
    return df.filter(F.col(time) >= lower if upper is None else F.col(time).between(lower, upper))


def interval(n: int, unit: str) -> Column:
    return F.expr(f"INTERVAL {int(n)} {unit}")
