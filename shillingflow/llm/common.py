"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import write_out
from .hashing import SpanHasher

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of the named columns."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them where the table has them already."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def with_running(df: DataFrame, keys: list[str], order: list[str], weight: Column | None, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``weight`` (or the number) of the rows that precede a row within its key.

    The rows are dealt by range of key and order, so a key that holds most rows is spread over many
    tasks; each task sums its part, and one row per key and part carries what lies before it. The
    dealt rows are written to the shared folder, which fixes the parts for both uses.
    """
    spark = df.sparkSession
    heavy, part, inner, base = fresh(df, "_weight", "_part", "_inside", "_base")
    ranged = df.withColumn(heavy, F.lit(1).cast("long") if weight is None else weight.cast("long"))
    ranged = ranged.repartitionByRange(partitions(spark), *[F.col(c) for c in [*keys, *order]])
    placed = write_out(ranged.withColumn(part, F.spark_partition_id()), "running")
    per = placed.groupBy(part, *keys).agg(F.sum(heavy).alias(heavy))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(part, *keys, F.coalesce(F.sum(heavy).over(earlier), F.lit(0)).alias(base))
    inside = Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn(inner, F.coalesce(F.sum(heavy).over(inside), F.lit(0)))
    joined = summed.join(before, same(summed, before, [part, *keys]))
    return joined.select(*[summed[c] for c in df.columns if c != out], (F.col(inner) + F.col(base)).alias(out))


SHORT = 2_000_000


def short_list(ids: DataFrame, most: int = SHORT) -> DataFrame:
    """A written table of a few narrow columns, sent to all tasks if it has at most ``most`` rows; beyond, joins shuffle it."""
    return F.broadcast(ids) if ids.count() <= most else ids


def groups_for(rows: int, per_group: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / per_group))


def give_back() -> None:
    """Returns what a worker's finished work has freed to the machine: workers are used again by later
    stages, and freed memory would otherwise stay theirs."""
    SpanHasher.shrink_all()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over the batches of a task; the worker's memory is given back at its end."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


LARGE = 4 << 20  # bytes of a group above which its memory is given back


def released_group(run: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``run`` over a group, or two that belong together; see ``released``."""
    def one(part: pa.Table) -> pa.Table:
        out = run(part)
        if part.nbytes > LARGE:
            give_back()
        return out

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        if left.nbytes + right.nbytes > LARGE:
            give_back()
        return out

    return one if run.__code__.co_argcount == 1 else two
