"""Streaming inputs: Kafka topics and folders that grow."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from tillwater.operators.parsing import parse_json

OFFSET_BITS = 44


def kafka_options(servers: str, topic: str, start: str = "latest") -> dict[str, str]:
    """Reader options: committed records only, from the latest or earliest offset."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "kafka.isolation.level": "read_committed",
        "failOnDataLoss": "true",
    }


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, start: str = "latest",
    per_batch: int | None = None,
) -> DataFrame:
    """A topic as a streaming DataFrame with columns `value` and `tie`.

    `tie` is the record's place in the topic as one number. It tells equal
    records apart and orders those of one partition as they arrived.
    `per_batch` bounds the offsets of one micro-batch, so that a restart after
    a long stop does not pull the whole backlog into one batch.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, start))
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().selectExpr(
        "CAST(value AS STRING) AS value",
        f"shiftleft(CAST(partition AS BIGINT), {OFFSET_BITS}) + offset AS tie",
    )


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    fmt: str = "parquet", only: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """A folder as a streaming DataFrame; text folders give a `value` column."""
    reader = spark.readStream.format(fmt)
    if fmt != "text":
        reader = reader.schema(schema)
    if only:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def json_stream(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of a `value` column that parse; see parse_json for rejects."""
    good, _ = parse_json(raw, schema)
    return good


def with_event_time(df: DataFrame, et: Column, delay: str, name: str = "et") -> DataFrame:
    """Add the event-time column and the watermark that trails it."""
    return df.withColumn(name, et).withWatermark(name, delay)


def literal_records(spark: SparkSession, records: list[dict]) -> DataFrame:
    """A handful of records as a `value` column of JSON text."""
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
