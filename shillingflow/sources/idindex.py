"""A persistent index of landed ids, so that a batch is checked without reading the landed table.

Ids lie by arrival period (such as a month: long enough that a batch covers few of them) and hash bucket. Every batch adds one block; ``fan`` blocks of one size become
one block of the next size, so there are few blocks and an id is rewritten once per size. Which blocks
exist follows from the batch number alone: nothing is listed, and a batch that is run again reads what
it read the first time and overwrites what it wrote.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import empty_out

BUCKETS, FAN, PERIOD = 8, 8, "month"
SHORT = 500_000  # ids of a batch that are sent to all tasks; beyond, the check is a shuffled join
SCHEMA = "id string, since date, bucket int"


class IdIndex:
    """Ids under ``path``. With ``horizon_days`` a copy may arrive that many days after the first at most,
    and older periods are not read; without it, all are."""

    def __init__(self, spark: SparkSession, path: str, key: str = "transaction_id", arrival: str = "received_at",
                 buckets: int = BUCKETS, fan: int = FAN, horizon_days: int | None = None, period: str = PERIOD):
        self.spark, self.path, self.key, self.arrival = spark, path, key, arrival
        self.buckets, self.fan, self.horizon_days, self.period = buckets, fan, horizon_days, period

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def _since(self, time: Column) -> Column:
        return F.date_trunc(self.period, time).cast("date")

    def _place(self, block: tuple[int, int]) -> str:
        return f"{self.path}/{block[0]:012d}-{block[1]:012d}"

    def _read(self, blocks: list[tuple[int, int]]) -> DataFrame:
        if not blocks:
            return self.spark.createDataFrame([], SCHEMA)
        return reduce(DataFrame.unionByName, [self.spark.read.schema(SCHEMA).parquet(self._place(b)) for b in blocks])

    def _write(self, ids: DataFrame, block: tuple[int, int]) -> None:
        # a period's bucket is one file unless it is large; then the rebalance cuts it
        ids.hint("rebalance", "since", "bucket").sortWithinPartitions("since", "bucket", "id").write.mode("overwrite").partitionBy(
            "since", "bucket").parquet(self._place(block))

    def blocks(self, batch_id: int) -> list[tuple[int, int]]:
        """Blocks that hold the ids of all batches before this one: the last batch's own, and as large ones as
        were complete when it ran."""
        out, at, until = [], 0, max(batch_id - 1, 0)
        while at < until:
            size = 1
            while at % (size * self.fan) == 0 and at + size * self.fan <= until:
                size *= self.fan
            out.append((at, at + size))
            at += size
        return out + ([(until, until + 1)] if batch_id else [])

    def _complete(self, number: int) -> list[tuple[tuple[int, int], list[tuple[int, int]]]]:
        """Larger blocks that end before batch ``number``, smallest first, with the blocks that make them up."""
        out, size = [], self.fan
        while number and number % size == 0:
            step = size // self.fan
            out.append(((number - size, number), [(a, a + step) for a in range(number - size, number, step)]))
            size *= self.fan
        return out

    def compact(self, batch_id: int) -> None:
        """Merges blocks of earlier batches; nothing that this batch reads changes, so it may run beside it.
        Blocks merged by the batch before are emptied: that batch is done and won't run again."""
        for whole, parts in self._complete(batch_id):
            self._write(self._read(parts), whole)
        for _, parts in self._complete(batch_id - 1) if batch_id else []:
            for part in parts:
                empty_out(self.spark, self._place(part), SCHEMA)

    def stored(self, incoming: DataFrame, batch_id: int) -> tuple[DataFrame, int]:
        """The part of the index that ids of ``incoming`` can meet (its buckets, and its periods with a horizon), and
        the number of incoming rows with an id."""
        known = incoming.filter(F.col(self.key).isNotNull())
        seen = known.agg(F.collect_set(self._bucket()).alias("buckets"), F.to_date(F.min(self.arrival)).alias("oldest"),
                         F.count(F.lit(1)).alias("n")).first()
        part = self._read(self.blocks(batch_id)).filter(F.col("bucket").isin(sorted(seen["buckets"])))
        if self.horizon_days is not None and seen["oldest"] is not None:
            first = self._since(F.lit(seen["oldest"] - timedelta(days=self.horizon_days)))
            part = part.filter((F.col("since") >= first) | F.col("since").isNull())
        return part, seen["n"]

    def held(self, incoming: DataFrame, batch_id: int) -> DataFrame:
        """The ids of ``incoming`` that an earlier batch landed. A batch's few ids go to the index, not the other way."""
        part, n = self.stored(incoming, batch_id)
        ids = incoming.filter(F.col(self.key).isNotNull()).select(F.col(self.key).cast("string").alias("id")).distinct()
        return part.select("id").join(F.broadcast(ids) if n <= SHORT else ids, "id", "left_semi")

    def add(self, landed: DataFrame, batch_id: int) -> None:
        """Adds the ids that a batch landed."""
        ids = landed.filter(F.col(self.key).isNotNull()).select(
            F.col(self.key).cast("string").alias("id"), self._since(F.col(self.arrival)).alias("since"), self._bucket().alias("bucket"))
        self._write(ids, (batch_id, batch_id + 1))
