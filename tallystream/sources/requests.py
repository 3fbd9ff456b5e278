"""Request batches and stream messages, as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tallystream.schemas import MESSAGE_SCHEMA

REQUEST_SCHEMA = StructType(
    [
        StructField("request_id", StringType()),
        StructField("received_at", TimestampType()),
        StructField("api_key", StringType()),
        StructField("forwarded_for", StringType()),
        StructField("real_ip", StringType()),
        StructField("peer_ip", StringType()),
        StructField("user_agent", StringType()),
        StructField("body", StringType()),
    ]
)


def read_bodies(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Files holding one request body each: (request_id = file path, body)."""
    reader = spark.readStream if stream else spark.read
    files = reader.schema("value string").option("wholetext", "true").text(path)
    return files.select(F.col("_metadata.file_path").alias("request_id"), F.col("value").alias("body"))


def read_requests(
    spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Request records with headers, one JSON object per line."""
    return _json(spark, path, REQUEST_SCHEMA, stream, max_files_per_trigger)


def stream_events(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream messages (value, stream, sequence, published_at) from JSON files.

    max_files_per_trigger bounds a micro-batch.
    """
    return _json(spark, path, MESSAGE_SCHEMA, True, max_files_per_trigger)


def stream_events_kafka(
    spark: SparkSession, servers: str, topic_pattern: str, max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """The same columns from a Kafka log: topic is the stream, partition-offset the sequence.

    Needs Spark's Kafka package on the class path. Not exercised by the tests.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topic_pattern)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias("stream"),
        F.col("offset").cast("string").alias("sequence"),
        F.col("timestamp").alias("published_at"),
    )


def _json(spark, path, schema, stream, max_files_per_trigger) -> DataFrame:
    if not stream:
        return spark.read.schema(schema).json(path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)
