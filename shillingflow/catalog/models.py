"""Staging models and marts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import marts, staging
from ..session import shared_dir
from ..sources import warehouse
from ..sources.dataset import Dataset
from .base import query

_TX = """transaction_id, customer_phone_number, account_reference,
  CAST(transaction_amount AS DOUBLE) AS transaction_amount, transaction_timestamp, transaction_date,
  transaction_hour, day_of_week, loaded_at, amount_category, transaction_sequence_per_customer"""


def _plain(df):
    return df.withColumn("transaction_amount", F.col("transaction_amount").cast("double"))


@query("mart_hourly_volumes", "SELECT * FROM hourly")
def _(d: Dataset):
    return d.hourly


@query("mart_daily_transactions", "SELECT * FROM daily")
def _(d: Dataset):
    return d.daily


@query("mart_county_heatmap", "SELECT * FROM heatmap")
def _(d: Dataset):
    return d.heatmap


@query("stg_raw_events", "SELECT * FROM stg_raw")
def _(d: Dataset):
    return d.stg_raw


@query("stg_c2b_transactions", f"SELECT {_TX} FROM staged")
def _(d: Dataset):
    return _plain(staging.with_sequence(staging.stage_c2b(d.stg_raw)))


@query("txn_sequence", f"SELECT {_TX} FROM tx")
def _(d: Dataset):
    return _plain(d.tx_sequenced)


@query("warehouse_hourly", """
SELECT CAST(transaction_time AS DATE) AS date, hour(transaction_time) AS hour, 'C2B' AS transaction_type,
  count(*) AS total_transactions, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CAST(sum(amount) AS DOUBLE) / count(*) AS average_amount,
  count(*) FILTER (transaction_status = 'completed') AS successful_transactions,
  count(*) FILTER (transaction_status = 'failed') AS failed_transactions,
  round(100.0::DOUBLE * count(*) FILTER (transaction_status = 'completed') / count(*), 2) AS success_rate_percent
FROM payments GROUP BY 1, 2, 3""")
def _(d: Dataset):
    return marts.warehouse_hourly(d.payments)


@query("warehouse_county", """
SELECT CAST(transaction_time AS DATE) AS date, region AS county_name, count(*) AS transaction_count,
  CAST(sum(amount) AS DOUBLE) AS transaction_volume,
  CAST(sum(amount) AS DOUBLE) / count(*) AS average_transaction_size
FROM payments GROUP BY 1, 2""")
def _(d: Dataset):
    return marts.warehouse_county(d.regional)


@query("warehouse_write", """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS rows,
  CAST(sum(transaction_amount) AS DOUBLE) AS total FROM tx GROUP BY 1""")
def _(d: Dataset):
    """Monthly folders here: the test tables hold few rows for each of many days."""
    path = shared_dir(d.spark, "warehouse")
    monthly = d.tx.withColumn("month", F.trunc("transaction_date", "month"))
    warehouse.warehouse_write(monthly, path, "month", ["transaction_date", "customer_phone_number"], "transaction_id")
    return d.spark.read.parquet(path).groupBy("month").agg(
        F.count("*").alias("rows"), F.sum("transaction_amount").cast("double").alias("total")
    )


@query("model_views", """
SELECT 'stg_raw_events' AS model, count(*) AS rows FROM stg_raw
UNION ALL SELECT 'stg_c2b_transactions', count(*) FROM staged
UNION ALL SELECT 'mart_hourly_volumes', count(*) FROM (SELECT DISTINCT date_trunc('hour', transaction_timestamp) FROM staged) a
UNION ALL SELECT 'mart_daily_transactions', count(*) FROM
  (SELECT DISTINCT transaction_date, customer_phone_number, account_reference FROM staged) b
UNION ALL SELECT 'mart_county_heatmap', count(*) FROM (SELECT DISTINCT transaction_date, account_reference FROM staged) c""")
def _(d: Dataset):
    names = warehouse.model_views(d.raw_feed)
    return reduce(DataFrame.unionByName, [
        d.spark.table(n).agg(F.count("*").alias("rows")).withColumn("model", F.lit(n)) for n in names
    ])


@query("snapshot_verify", "SELECT 'tx' AS table_name, count(*) AS stored_count, count(*) AS row_count, true AS intact FROM tx")
def _(d: Dataset):
    path = shared_dir(d.spark, "snapshot")
    warehouse.snapshot(d.tx, path, "tx")
    return warehouse.snapshot_verify(d.spark, path, "tx")
