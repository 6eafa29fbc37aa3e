"""Telemetry as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import parse_events, telemetry_envelope


def event_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """New files of JSON lines in a folder, as the raw telemetry table."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return telemetry_envelope(parse_events(reader.load(path), "value"), F.current_timestamp())


def event_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A Kafka topic of JSON events, as the raw telemetry table.

    Needs the Kafka connector on the class path. The broker's timestamp is the load time.
    """
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    parsed = records.select(
        F.try_parse_json(F.col("value").cast("string")).alias("event_data"), "timestamp"
    )
    return telemetry_envelope(parsed, F.col("timestamp"))


def table_stream(
    spark: SparkSession, path: str, ddl_or_schema, files_per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files of a folder, for example an append-only raw table."""
    reader = spark.readStream.schema(ddl_or_schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
