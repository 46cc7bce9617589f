"""Sharding over fixed virtual slots.

A record's key hashes into one of a few thousand slots, for good. A map from slot to shard is the
only thing that ever changes: every change makes a new version of it, stored as a small table.
Balancing edits the map from the bytes that the slots hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import with_running

SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]`` is the shard of a slot; ``version`` counts the edits."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    @staticmethod
    def even(shards: int, slots: int = SLOTS) -> "SlotMap":
        if not 1 <= shards <= slots:
            raise ValueError("there must be a slot for each shard")
        return SlotMap(1, shards, tuple(s % shards for s in range(slots)))

    def _loads(self, sizes: np.ndarray) -> np.ndarray:
        return np.bincount(self.shard_of, weights=sizes, minlength=self.shards)

    def rebalanced(self, sizes: np.ndarray, tolerance: float = 1e-4) -> "SlotMap":
        """Moves one slot at a time from the heaviest to the lightest shard, the one that closes most of
        their gap, until the gap is within ``tolerance`` of a mean shard. A shard of which no slot narrows
        the gap, such as one that a single long document fills, is set aside and the others go on."""
        owner, load = np.array(self.shard_of), self._loads(sizes)
        enough = tolerance * max(load.mean(), 1.0)
        movable = np.ones(self.shards, bool)
        while movable.any():
            high, low = int(np.where(movable, load, -1.0).argmax()), int(load.argmin())
            gap = load[high] - load[low]
            if gap <= enough:
                break
            held = np.flatnonzero((owner == high) & (sizes > 0) & (sizes < gap))
            if not len(held):
                movable[high] = False
                continue
            slot = held[np.abs(sizes[held] - gap / 2).argmin()]
            owner[slot] = low
            load[high] -= sizes[slot]
            load[low] += sizes[slot]
        return SlotMap(self.version + 1, self.shards, tuple(int(x) for x in owner))

    def grown(self, sizes: np.ndarray) -> "SlotMap":
        """One more shard, which takes slots from the heaviest shards; no other slot moves."""
        owner = np.array(self.shard_of)
        load = np.append(self._loads(sizes), 0.0)
        share = load.sum() / len(load)
        while load[-1] < share:
            high = int(load[:-1].argmax())
            held = np.flatnonzero((owner == high) & (sizes > 0) & (load[-1] + sizes <= share * 1.001))
            if not len(held):
                break
            slot = held[sizes[held].argmax()]
            owner[slot] = len(load) - 1
            load[high] -= sizes[slot]
            load[-1] += sizes[slot]
        return SlotMap(self.version + 1, self.shards + 1, tuple(int(x) for x in owner))

    def rows(self, spark: SparkSession) -> DataFrame:
        data = [(self.version, self.shards, s, int(x)) for s, x in enumerate(self.shard_of)]
        return spark.createDataFrame(data, "version int, shards int, virtual_slot int, shard int")

    def save(self, spark: SparkSession, path: str) -> None:
        self.rows(spark).coalesce(1).write.parquet(f"{path}/version={self.version}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int) -> "SlotMap":
        got = spark.read.parquet(f"{path}/version={version}").orderBy("virtual_slot").collect()
        return SlotMap(version, got[0].shards, tuple(r.shard for r in got))


def virtual_slot(docs: DataFrame, key: str, slots: int) -> Column:
    """The slot of a key. Rows without a key are spread by all their columns."""
    other = F.xxhash64(*[F.col(c) for c in docs.columns if docs.schema[c].dataType.typeName() not in ("map", "variant")])
    return F.pmod(F.when(F.col(key).isNull(), other).otherwise(F.xxhash64(key)), F.lit(slots)).cast("int")


def slot_bytes(docs: DataFrame, key: str, size: str, slots: int = SLOTS) -> np.ndarray:
    """Bytes per slot: at most ``slots`` rows reach the driver, whatever the input."""
    got = docs.groupBy(virtual_slot(docs, key, slots).alias("virtual_slot")).agg(F.sum(size).alias("bytes")).collect()
    sizes = np.zeros(slots)
    for r in got:
        sizes[r.virtual_slot] = r.bytes or 0
    return sizes


def place(docs: DataFrame, slot_map: SlotMap, key: str = "doc_id") -> DataFrame:
    """Adds ``virtual_slot``, ``shard``, ``map_version`` and ``slot``, the row's place in its shard
    (gapless from 0, by key). Columns of these names are replaced. The map has at most a few thousand
    rows and is broadcast."""
    added = ["virtual_slot", "shard", "map_version", "slot"]
    docs = docs.drop(*added)
    slots = len(slot_map.shard_of)
    mapped = slot_map.rows(docs.sparkSession).select("virtual_slot", "shard", F.col("version").alias("map_version"))
    placed = docs.withColumn("virtual_slot", virtual_slot(docs, key, slots)).join(F.broadcast(mapped), "virtual_slot")
    return with_running(placed, ["shard"], [key, "virtual_slot"], None, "slot")


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", size: str = "size", slots: int = SLOTS,
                    maps: str | None = None) -> tuple[DataFrame, SlotMap]:
    """Shards of near equal bytes: an even map, then one edit from the bytes per slot.

    Both versions are stored under ``maps`` (by default a fresh folder in the shared one). Null sizes
    count as 0; an empty table keeps the even map; repeated rows share a slot; null keys are spread.
    """
    spark = docs.sparkSession
    maps = maps or shared_dir(spark, "slot-maps")
    first = SlotMap.even(shards, slots)
    first.save(spark, maps)
    edited = first.rebalanced(slot_bytes(docs, key, size, slots))
    edited.save(spark, maps)
    return place(docs, edited, key), edited


def op4(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The contract's columns; a null text has 0 bytes and the checksum of the empty string."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed, _ = shard_documents(sized, shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
