"""Partitioned tables, model views and verified snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, staging

# Date column and clustering of each warehouse table.
LAYOUTS = {
    "raw": ("received_date", ["phone_number"]),
    "staging": ("transaction_date", ["transaction_type", "merchant_code", "county_code", "status"]),
    "hourly": ("date", ["transaction_type", "hour"]),
    "county": ("date", ["county_name"]),
}


def warehouse_write(df: DataFrame, path: str, date: str, cluster: list[str], spread: str | None = None,
                    mode: str = "overwrite") -> None:
    """Day-partitioned files, clustered inside.

    Ranges over date, clustering and ``spread`` keep a heavy day from landing in one task, and
    most days still end up in few files.
    """
    order = [date, *cluster, *([spread] if spread else [])]
    (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode(mode).partitionBy(date).parquet(path)
    )


def save_raw(raw: DataFrame, path: str, spread: str = "transaction_id", mode: str = "append") -> None:
    """Landed events by day of arrival, which is what panels and checks of arrivals ask for."""
    date, cluster = LAYOUTS["raw"]
    warehouse_write(raw.withColumn(date, F.to_date("received_at")), path, date, cluster, spread, mode)


def build_models(raw: DataFrame, built_at: Column | None = None) -> dict[str, DataFrame]:
    """Staging and marts over landed events."""
    stg_raw = staging.stage_raw(raw)
    tx = staging.with_sequence(staging.stage_c2b(stg_raw))
    built_at = F.current_timestamp() if built_at is None else built_at
    hourly = marts.hourly_volumes(tx).withColumn("created_at", built_at)
    daily = marts.daily_transactions(tx).withColumn("created_at", built_at).withColumn("updated_at", built_at)
    return {
        "stg_raw_events": stg_raw,
        "stg_c2b_transactions": tx.withColumn("processed_at", built_at),
        "mart_hourly_volumes": hourly,
        "mart_daily_transactions": daily,
        "mart_county_heatmap": marts.county_heatmap(tx),
    }


def model_views(raw: DataFrame, built_at: Column | None = None) -> list[str]:
    """Register every model as a temporary view."""
    models = build_models(raw, built_at)
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return list(models)


def save_models(raw: DataFrame, path: str, built_at: Column | None = None) -> list[str]:
    """Rebuild the models as parquet tables; marts read the saved staging table."""
    spark = raw.sparkSession
    stg = staging.with_sequence(staging.stage_c2b(staging.stage_raw(raw)))
    warehouse_write(stg, f"{path}/stg_c2b_transactions", "transaction_date", ["customer_phone_number"], "transaction_id")
    tx = spark.read.parquet(f"{path}/stg_c2b_transactions")
    built_at = F.current_timestamp() if built_at is None else built_at
    tables = {
        "mart_hourly_volumes": marts.hourly_volumes(tx),
        "mart_daily_transactions": marts.daily_transactions(tx),
        "mart_county_heatmap": marts.county_heatmap(tx),
    }
    for name, df in tables.items():
        df.withColumn("created_at", built_at).write.mode("overwrite").parquet(f"{path}/{name}")
    return ["stg_c2b_transactions", *tables]


def snapshot(df: DataFrame, path: str, name: str) -> None:
    """Copy of a table plus a manifest row with its count and content sum."""
    df.write.mode("errorifexists").parquet(f"{path}/{name}/data")
    _fingerprint(df.sparkSession.read.parquet(f"{path}/{name}/data"), name).withColumn(
        "taken_at", F.current_timestamp()
    ).write.parquet(f"{path}/{name}/manifest")


def _fingerprint(df: DataFrame, name: str) -> DataFrame:
    row_hash = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(row_hash), F.lit(0)).alias("content_sum")).select(
        F.lit(name).alias("table_name"), "*"
    )


def snapshot_verify(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One row: stored and actual count, and whether count and content agree."""
    actual = _fingerprint(spark.read.parquet(f"{path}/{name}/data"), name)
    stored = spark.read.parquet(f"{path}/{name}/manifest").select(
        "table_name", F.col("row_count").alias("stored_count"), F.col("content_sum").alias("stored_sum")
    )
    return stored.join(actual, "table_name").select(
        "table_name", "stored_count", "row_count",
        ((F.col("stored_count") == F.col("row_count")) & (F.col("stored_sum") == F.col("content_sum"))).alias("intact"),
    )


def restore(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Snapshot content, refused when it no longer matches its manifest."""
    if not snapshot_verify(spark, path, name).first()["intact"]:
        raise ValueError(f"snapshot of {name} does not match its manifest")
    return spark.read.parquet(f"{path}/{name}/data")
