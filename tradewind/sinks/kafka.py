"""K5: Kafka sink for an encoded message frame (key, value).

The connector jar is supplied by the deployer. Delivery settings are
pass-through producer options (``kafka.acks``, ``kafka.retries``, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

DEFAULT_PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "5"}


def write_kafka(messages: DataFrame, bootstrap_servers: str, topic: str, **producer_options) -> None:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update(DEFAULT_PRODUCER_OPTIONS)
    opts.update({k: str(v) for k, v in producer_options.items()})
    messages.select("key", "value").write.format("kafka").options(**opts).save()


def write_kafka_stream(messages: DataFrame, bootstrap_servers: str, topic: str,
                       checkpoint: str, **producer_options):
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic,
            "checkpointLocation": checkpoint}
    opts.update(DEFAULT_PRODUCER_OPTIONS)
    opts.update({k: str(v) for k, v in producer_options.items()})
    return messages.select("key", "value").writeStream.format("kafka").options(**opts).start()
