"""JSON callback files and Kafka topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def json_callbacks(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Array-of-objects files; every field is read as text."""
    return spark.read.schema(schemas.CALLBACK).option("multiLine", multiline).json(path)


def write_json_arrays(df: DataFrame, path: str, files: int) -> None:
    """Files that hold one array of objects each, as callbacks are handed over; rows are dealt in turn.
    The readers take such a file as one piece, so ``files`` should grow with the rows; a null field is left out."""
    rows = df.select(F.to_json(F.struct("*")).alias("row"))
    dealt = rows.groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(files)).alias("file")).agg(F.collect_list("row").alias("rows"))
    dealt.select(F.concat(F.lit("[\n"), F.array_join("rows", ",\n"), F.lit("\n]")).alias("value")).repartition(files).write.text(path)


def parse_events(messages: DataFrame, schema: T.StructType = schemas.EVENT, value: str = "value") -> DataFrame:
    """JSON messages to columns, with their text as ``payload``; an unreadable one also has it in ``_corrupt``."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    extra = [c for c in ("offset", "partition", "timestamp") if c in messages.columns]
    text = F.col(value).cast("string").alias("payload")
    return messages.select(parsed.alias("_e"), text, *extra).select("_e.*", "payload", *extra)


def kafka_source(spark: SparkSession, brokers: str, topic: str, max_per_trigger: int = 1_000_000, **options) -> DataFrame:
    """Topic from the earliest offset; offsets live in the checkpoint of the query."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_per_trigger)
        .option("failOnDataLoss", "true")
    )
    return reader.options(**options).load()


def read_events(spark: SparkSession, brokers: str, topic: str = schemas.TOPIC_TRANSACTIONS) -> DataFrame:
    return parse_events(kafka_source(spark, brokers, topic))


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as keyed JSON messages; one key stays in one topic partition."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_sink(df: DataFrame, brokers: str, topic: str, checkpoint: str, key: str = "phone_number"):
    """Streaming query that publishes ``df``; start it with ``.start()``."""
    messages = df if set(df.columns) == {"key", "value"} else to_messages(df, key)
    return (
        messages.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all").option("topic", topic).option("checkpointLocation", checkpoint)
    )
