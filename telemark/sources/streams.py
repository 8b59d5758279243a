"""Streaming sources: message topics and tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(
    servers: str, topic: str, group: str, max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a topic subscription: start at latest, tolerate lost offsets."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_raw(spark: SparkSession, servers: str, topic: str, group: str,
              max_offsets: int | None = None) -> DataFrame:
    """Raw messages of a topic. Needs the Kafka connector on the classpath."""
    stream = spark.readStream.format("kafka")
    for key, value in kafka_options(servers, topic, group, max_offsets).items():
        stream = stream.option(key, value)
    return as_messages(stream.load())


def as_messages(df: DataFrame) -> DataFrame:
    """Key/value records of any source to `payload, kafka_ts, source_topic`."""
    return df.select(
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("kafka_ts"),
        F.col("topic").alias("source_topic"),
    )


MESSAGE_DDL = "value string, timestamp timestamp, topic string"


def file_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages landed as Parquet files, one micro-batch per `max_files` files."""
    stream = spark.readStream.schema(MESSAGE_DDL)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    return as_messages(stream.parquet(path))


def table_stream(
    spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """A Parquet table as a stream of its files."""
    stream = spark.readStream.schema(schema)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    if glob:
        stream = stream.option("pathGlobFilter", glob)
    return stream.parquet(path)
