"""Kafka streaming source and batch reader.

The connector jar (``spark-sql-kafka-0-10_2.13``) is supplied by the
deployer; it is not on this image's classpath, so these functions are
exercised only for their options here. Decoding is separate
(``sources.decode``) and takes any frame with a ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Reference defaults: start at the latest offset, tolerate lost offsets.
DEFAULT_STREAM_OPTIONS = {
    "startingOffsets": "latest",
    "failOnDataLoss": "false",
}


def kafka_options(bootstrap_servers: str, topic: str, **extra) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic}
    opts.update(DEFAULT_STREAM_OPTIONS)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                      max_offsets_per_trigger: int | None = None, **extra) -> DataFrame:
    """Streaming frame with Kafka's columns (key, value binary, topic, ...).

    ``max_offsets_per_trigger`` bounds each micro-batch, the Spark-side
    replacement for the feeders' send-rate pacing.
    """
    if max_offsets_per_trigger:
        extra["maxOffsetsPerTrigger"] = max_offsets_per_trigger
    return (spark.readStream.format("kafka")
            .options(**kafka_options(bootstrap_servers, topic, **extra)).load())


def read_kafka_batch(spark: SparkSession, bootstrap_servers: str, topic: str, **extra) -> DataFrame:
    opts = kafka_options(bootstrap_servers, topic, **extra)
    opts["startingOffsets"] = extra.get("startingOffsets", "earliest")
    return spark.read.format("kafka").options(**opts).load()
