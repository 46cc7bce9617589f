"""Payments per customer and day, kept as payments land, for numbers that would otherwise reread history.

Each increment adds its own counts, whatever days they belong to. A snapshot holds every customer's count
before a month; later increments that reach back behind it are still found by their number.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTS = "customer_phone_number string, day date, rows long, batch long, month string"
TOTALS = "customer_phone_number string, rows long, month string, upto long"
PHONE, TIME, DAY = "customer_phone_number", "transaction_timestamp", "transaction_date"
NO_TIME = dt.date(1000, 1, 1)  # rows without a time come before all others
NO_MONTH = "0000-00"


class History:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def start(self) -> "History":
        """Lays down the empty folders."""
        for schema, name in ((COUNTS, "counts"), (TOTALS, "totals")):
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{name}")
        return self

    def add(self, rows: DataFrame, batch: int) -> None:
        """Counts of an increment; run again, it overwrites its own."""
        day = F.coalesce(F.col(DAY), F.to_date(TIME), F.lit(NO_TIME))
        counted = rows.groupBy(F.col(PHONE), day.alias("day")).agg(F.count(F.lit(1)).alias("rows")).withColumn(
            "month", F.when(F.col("day") == F.lit(NO_TIME), NO_MONTH).otherwise(F.date_format("day", "yyyy-MM")))
        counted.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{self.path}/counts/batch={batch}")

    def _counts(self) -> DataFrame:
        return self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts")

    def _latest(self, month: str) -> tuple[str, int]:
        """The newest snapshot that is not after ``month``: its month and the last increment in it."""
        files = self.spark.read.schema(TOTALS).parquet(f"{self.path}/totals").inputFiles()
        found = {(m[1], int(m[2])) for m in (re.search(r"month=([\d-]+)/upto=(-?\d+)/", f) for f in files) if m}
        return max((f for f in found if f[0] <= month), default=("", -1))

    def _before(self, month: str, day: dt.date) -> DataFrame:
        since, upto = self._latest(month)
        counts = self._counts().filter((F.col("month") <= month) & (F.col("day") < F.lit(day)))
        if not since:
            return counts.select(PHONE, "rows")
        late = (F.col("month") >= since) | (F.col("batch") > upto)
        totals = self.spark.read.schema(TOTALS).parquet(f"{self.path}/totals").filter((F.col("month") == since) & (F.col("upto") == upto))
        return totals.select(PHONE, "rows").unionByName(counts.filter(late).select(PHONE, "rows"))

    def before(self, day: dt.date) -> DataFrame:
        """``customer_phone_number, rows``: payments before ``day``, from the newest snapshot, the days after it
        and late increments. Null customers are one customer."""
        return self._before(f"{day:%Y-%m}", day).groupBy(PHONE).agg(F.sum("rows").alias("rows"))

    def snapshot(self, month: str, upto: int) -> None:
        """Totals before ``month`` (``yyyy-MM``) over the increments up to ``upto``, from the snapshot before it."""
        first = dt.date(int(month[:4]), int(month[5:]), 1)
        before = f"{first - dt.timedelta(days=1):%Y-%m}"
        since, had = self._latest(before)
        if had > upto:
            raise ValueError(f"the snapshot of {since} already holds increment {had}")
        counts = self._counts().filter((F.col("month") <= before) & (F.col("batch") <= upto))
        parts = counts.select(PHONE, "rows")
        if since:
            totals = self.spark.read.schema(TOTALS).parquet(f"{self.path}/totals").filter((F.col("month") == since) & (F.col("upto") == had))
            parts = totals.select(PHONE, "rows").unionByName(counts.filter((F.col("month") >= since) | (F.col("batch") > had)).select(PHONE, "rows"))
        parts.groupBy(PHONE).agg(F.sum("rows").alias("rows")).write.mode("overwrite").parquet(f"{self.path}/totals/month={month}/upto={upto}")
