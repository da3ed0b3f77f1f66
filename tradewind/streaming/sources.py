"""Streaming sources other than Kafka (S5 lives in ``sources.kafka``).

A *message log* is a directory of Parquet files with Kafka's two payload
columns (``key``, ``value``); it stands in for a topic wherever the Kafka
connector is absent (tests) and feeds the very same decode and enrichment
code. A table streams in place, without a copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import MESSAGE_SCHEMA


def write_message_log(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Append an encoded (key, value) frame to a message-log directory."""
    messages.select("key", "value").write.mode(mode).parquet(path)


def read_message_stream(spark: SparkSession, path: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (key, value) frame over a message-log directory."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the table ``{name}.parquet`` (a file or a folder of files) in
    place: nothing is copied. ``max_files_per_trigger`` bounds a micro-batch;
    leave it unset where event-time order matters, since files of a table are
    not in that order and later batches would find their rows late."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    r = spark.readStream.schema(schema if schema is not None else spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # As a pattern, since the file source takes a single file in no other way.
    return r.parquet(path[:-1] + "[t]")
