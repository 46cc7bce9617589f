"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "shillingflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job over ``input_bytes``: about 128 MB per shuffle partition, at least two
    waves of tasks, and larger input splits once there are more of them than the cluster can use.

    AQE merges partitions that turn out small, so the numbers err on the high side.
    """
    mb = 1 << 20
    shuffles = max(2 * cores, -(-input_bytes // (128 * mb)))
    split = min(max(input_bytes // max(8 * cores, 1), 64 * mb), 512 * mb)
    return {
        "spark.sql.shuffle.partitions": str(min(shuffles, 200_000)),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mb),
    }


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    master, where driver and executors share a disk, may fall back to a temporary one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="shillingflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, "shillingflow", purpose, uuid.uuid4().hex)


def write_out(df, purpose: str):
    """Write ``df`` to the shared folder and read it back; cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_out(spark: SparkSession, path: str, schema) -> None:
    """Empties a written table that nothing reads any more; an overwrite, so it works on any store."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
