"""Bounded runs of streaming queries and replay-safe batch output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ROCKSDB, shared_dir

WATERMARK = "10 minutes"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state lives in RocksDB, on disk rather than on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch owns one folder; a replay after a failure overwrites exactly that folder."""
    df.write.mode("overwrite").parquet(batch_path(path, batch_id))


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append"):
    """Process everything that is there, then stop. Restarting with the checkpoint continues."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(sink).start()
    )
    query.awaitTermination()
    return query


def materialize(stream: DataFrame, purpose: str, mode: str = "append") -> DataFrame:
    """Output of a bounded run as a table with the batch number of every row."""
    spark = stream.sparkSession
    path = shared_dir(spark, purpose)
    run_available(stream, lambda df, n: write_batch(df, f"{path}/out", n), f"{path}/checkpoint", mode)
    return spark.read.schema(with_batch(stream.schema)).parquet(f"{path}/out")


def with_batch(schema: T.StructType) -> T.StructType:
    """Schema of a batch-numbered table; the given schema stays as it is."""
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of every key of an update-mode run."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_v")).select(*keys, "_v.*")
