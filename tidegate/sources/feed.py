"""Message feeds in the row shape of Spark's Kafka source.

``key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, headers ARRAY<STRUCT<key
STRING, value BINARY>>`` — a live topic or a recorded log in files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.casts import cast_to_target
from .config import KafkaSource

FEED_SCHEMA = (
    T.StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
    .add("headers", T.ArrayType(T.StructType().add("key", "string").add("value", "binary")))
)

# Names of the message metadata columns.
METADATA_COLUMNS = {
    "key": "kafka_key",
    "offset": "kafka_offset",
    "partition": "kafka_partition",
    "timestamp": "kafka_timestamp",
    "headers": "kafka_headers",
    "payload": "kafka_payload",
}
UPSERT_KEY = "rw_key"


def read_topic(spark: SparkSession, source: KafkaSource, streaming: bool = True) -> DataFrame:
    """The topic itself; needs the Kafka connector package on the session."""
    reader = spark.readStream if streaming else spark.read
    options = {"includeHeaders": "true", **source.reader_options()}
    return reader.format("kafka").options(**options).load()


def read_recorded(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """A recorded log in Parquet files."""
    if not streaming:
        return spark.read.schema(FEED_SCHEMA).parquet(path)
    reader = spark.readStream.schema(FEED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def from_timestamp(feed: DataFrame, millis: int) -> DataFrame:
    """Messages stamped at or after ``millis``."""
    return feed.filter(F.col("timestamp") >= F.timestamp_millis(F.lit(millis).cast("long")))


def end_offsets(feed: DataFrame) -> DataFrame:
    """Last offset of every topic partition."""
    return feed.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))


def after_offsets(feed: DataFrame, ends: DataFrame) -> DataFrame:
    """Messages past the given ends; a partition without an end is taken whole.

    ``ends`` has one row per topic partition, a number set when the topic is made, so it is broadcast.
    """
    past = feed.join(F.broadcast(ends), ["topic", "partition"], "left")
    return past.filter(F.col("last_offset").isNull() | (F.col("offset") > F.col("last_offset"))).select(*feed.columns)


def header_value(name: str, target: str = "VARCHAR") -> Column:
    """The last header of that name, cast; null when the message has none."""
    same = F.filter("headers", lambda h: h["key"] == name)
    return cast_to_target(F.try_element_at(same, F.lit(-1))["value"].cast("string"), target)


def metadata_columns(
    key: bool = False,
    offset: bool = False,
    partition: bool = False,
    timestamp: bool = False,
    headers: bool = False,
    payload: bool = False,
    header_fields: Mapping[str, str] | None = None,
    message_format: str = "PLAIN",
    encode: str = "JSON",
    stored: bool = True,
) -> list[Column]:
    """Message metadata to keep next to the decoded columns.

    The key of a stored UPSERT table is named ``rw_key``, any other ``kafka_key``. The payload exists for JSON only.
    """
    names = METADATA_COLUMNS
    out: list[Column] = []
    if key:
        upsert = message_format.upper() == "UPSERT" and stored
        out.append(F.col("key").alias(UPSERT_KEY if upsert else names["key"]))
    if offset:
        out.append(F.col("offset").alias(names["offset"]))
    if partition:
        out.append(F.col("partition").alias(names["partition"]))
    if timestamp:
        out.append(F.col("timestamp").alias(names["timestamp"]))
    if headers:
        out.append(F.col("headers").alias(names["headers"]))
    if payload and encode.upper() == "JSON":
        out.append(F.col("value").cast("string").alias(names["payload"]))
    out += [header_value(h, t).alias(h) for h, t in (header_fields or {}).items()]
    return out
