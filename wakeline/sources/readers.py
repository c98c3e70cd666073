"""Streams of raw messages: Kafka, a recorded topic, or JSON lines.

All give ``raw`` and, except for JSON lines, the position of the message. The
Kafka source needs Spark's Kafka connector on the class path.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schema import TOPIC_RECORD
from wakeline.sources.wire import publish_records


def positioned(records: DataFrame) -> DataFrame:
    """Raw text and position of Kafka records."""
    return records.select(
        F.col("value").cast("string").alias("raw"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.date_trunc("millisecond", "timestamp").alias("kafka_timestamp"),
    )


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_batch: int | None = None,
) -> DataFrame:
    """Messages of a topic. Offsets continue from the checkpoint; ``starting``
    counts only for a new one."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return positioned(reader.load())


def kafka_table(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds now, for a batch replay."""
    return positioned(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )


def recorded_table(spark: SparkSession, path: str) -> DataFrame:
    """A recorded topic as one table, for a batch replay."""
    return positioned(spark.read.schema(TOPIC_RECORD).json(path))


def recorded_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A topic recorded as JSON files with key, value, partition, offset, timestamp."""
    return positioned(
        spark.readStream.schema(TOPIC_RECORD)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def jsonl_stream(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Lines of the files arriving in a folder; blank lines are skipped.

    With ``since``, files last changed before it are passed over.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(path)
    if since is not None:
        lines = lines.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    return lines.where(F.trim("value") != "").select(F.col("value").alias("raw"))


def open_stream(
    spark: SparkSession,
    source: str = "auto",
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    **options,
) -> DataFrame:
    """``kafka``, ``recorded`` or ``file``; ``auto`` takes Kafka when servers are named.

    There is no fallback when the chosen source cannot be reached: that fails.
    ``options`` go to the source's own function.
    """
    if source == "auto":
        source = "kafka" if servers else "file"
    if source == "kafka":
        if not (servers and topic):
            raise ValueError("a Kafka source needs servers and topic")
        return kafka_stream(spark, servers, topic, **options)
    if not path:
        raise ValueError(f"a {source} source needs a path")
    if source == "recorded":
        return recorded_stream(spark, path, **options)
    if source == "file":
        return jsonl_stream(spark, path, **options)
    raise ValueError(f"unknown source {source!r}")


def publish_to_kafka(rows: DataFrame, servers: str, topic: str) -> None:
    """Send rows as keyed JSON messages, acknowledged by all replicas."""
    (
        publish_records(rows)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )
