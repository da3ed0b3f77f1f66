"""End-to-end jobs, one per runnable flow of the reference.

Each job is a composition of the library's operators with the reference's
parameters as arguments (paths, topic, trigger, durations). Batch jobs return
their result frames in a dict (nothing is collected); stream jobs return the
running ``StreamingQuery``. Stream jobs read Kafka by default, or any frame
with a ``value`` column passed as ``messages`` (e.g. a message log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from .. import streaming as st
from ..sinks import files as sinks
from ..sources import files as src
from ..session import shared_dir
from ..sinks.kafka import write_kafka
from ..sources.kafka import read_kafka_stream
from ..sources.lookup import trader_lookup

TRADE_CSV_SCHEMA = ("trade_id string, exchange string, coin string, trader_id string, "
                    "amount_usd double, event_time string")
ENRICH_PARTITIONS = ("day_of_week", "amount_category")


def trade_batch(spark: SparkSession, csv_path: str, output_path: str,
                lookup: DataFrame | None = None) -> dict[str, DataFrame]:
    """Trade batch: read CSV -> whales -> quality -> clean -> exchange stats
    -> lookup join / unmatched -> write stats (verified) -> summary.

    The CSV is parsed once, into a Parquet copy under the shared folder that
    all result frames read. ``lookup`` defaults to the five fixed traders."""
    copy = shared_dir(spark, "trades")
    sinks.write_parquet(src.read_csv(spark, csv_path, TRADE_CSV_SCHEMA), copy)
    raw = src.read_parquet(spark, copy)
    listed = lookup is None  # a driver-side list: known to be small
    lookup = trader_lookup(spark) if listed else lookup
    clean = ops.clean_trades(raw)
    stats = ops.exchange_stats(clean)
    written, stored = sinks.write_and_verify(stats, output_path)
    return {
        "raw": raw,
        "whales": ops.whale_trades(raw),
        "quality": ops.quality_report(raw),
        "clean": clean,
        "exchange_stats": stats,
        "joined": ops.lookup_join(clean, lookup, "trader_id", "left", broadcast=listed),
        "unmatched": ops.unmatched(clean, lookup, "trader_id", ["trade_id", "trader_id", "amount_usd"], broadcast=listed),
        "stored_stats": stored.withColumn("written_rows", F.lit(written).cast("bigint")),
        "summary": ops.trade_summary(raw),
    }


def transaction_batch(spark: SparkSession, csv_path: str, output_dir: str) -> dict[str, DataFrame]:
    """Transaction batch: raw CSV -> enrich -> Parquet (overwrite) plus the
    laundering counts and tier statistics of the enriched rows."""
    enriched = ops.enrich_transactions(src.read_raw_transactions_csv(spark, csv_path))
    sinks.write_parquet(enriched, output_dir, mode="overwrite")
    stored = spark.read.parquet(output_dir)
    return {
        "enriched": stored,
        "laundering_counts": ops.group_count(stored, "is_laundering"),
        "tier_stats": ops.tier_stats(stored),
    }


def transaction_summary(spark: SparkSession, parquet_path: str) -> dict[str, DataFrame]:
    """Summary of processed transactions (batch output or the stream's
    partitioned output): total, laundering share, amount description, tier,
    weekday and hour breakdowns."""
    df = spark.read.parquet(parquet_path)
    return {
        "total": ops.row_count(df),
        "laundering_share": ops.share_of_total(df, "is_laundering"),
        "amount_describe": ops.describe_column(df, "amount_received"),
        "amount_summary": ops.amount_summary(df, "amount_received"),
        "tier_stats": ops.tier_stats(df),
        "weekday_stats": ops.weekday_stats(df),
        "hour_stats": ops.hour_stats(df),
    }


def transaction_feed(spark: SparkSession, csv_path: str, bootstrap_servers: str | None = None,
                     topic: str = "transactions", limit: int | None = None, **producer_options) -> DataFrame:
    """Feed: raw CSV -> null strings to '' -> keyed JSON messages -> Kafka.
    ``limit`` sends the first rows by time only (the feeder's option). Without
    ``bootstrap_servers`` nothing is sent; the messages are returned either
    way."""
    rows = ops.head(src.read_raw_transactions_csv(spark, csv_path), limit, "ts")
    messages = ops.encode_transactions(ops.fill_nulls(rows, ""))
    if bootstrap_servers:
        write_kafka(messages, bootstrap_servers, topic, **producer_options)
    return messages


def trade_stream(spark: SparkSession, checkpoint: str | None, output_path: str | None = None,
                 bootstrap_servers: str = "localhost:9092", topic: str = "trades",
                 messages: DataFrame | None = None, output_mode: str = "update",
                 processing_time: str | None = "10 seconds", available_now: bool = False,
                 watermark: str = st.TRADE_WATERMARK, window: str = st.TRADE_WINDOW,
                 state_partitions: int | None = None, max_offsets_per_trigger: int | None = None):
    """Trade stream: messages -> decode -> watermark -> windowed counts and
    volume. ``output_path`` None prints to the console (update mode);
    otherwise a replay-safe batch sink (update/complete; read update output
    with ``last_wins``). ``max_offsets_per_trigger`` bounds a micro-batch, so a
    backlog is read in steps; Kafka hands it out in offset order."""
    source = messages if messages is not None else read_kafka_stream(spark, bootstrap_servers, topic, max_offsets_per_trigger)
    agg = st.trade_windows(source, window=window, watermark=watermark,
                           sort=(output_mode == "complete"))
    trigger = st.trigger_options(processing_time, available_now)
    if output_path is None:
        return st.start_console_sink(agg, output_mode, trigger=trigger, checkpoint=checkpoint)
    return st.start_batch_sink(agg, output_path, checkpoint, output_mode, trigger=trigger,
                               state_partitions=state_partitions)


def transaction_stream(spark: SparkSession, output_dir: str, checkpoint: str,
                       bootstrap_servers: str = "localhost:9092", topic: str = "transactions",
                       messages: DataFrame | None = None, batch_duration: int = 30,
                       available_now: bool = False, exactly_once_file_sink: bool = False,
                       on_batch=None, max_offsets_per_trigger: int | None = None):
    """Transaction stream: messages -> decode -> processing time -> enrich ->
    Parquet partitioned by weekday and tier, replay-safe. The checkpoint is
    a separate folder, never inside the data directory."""
    source = messages if messages is not None else read_kafka_stream(spark, bootstrap_servers, topic, max_offsets_per_trigger)
    enriched = st.enriched_transaction_stream(source)
    trigger = st.trigger_options(f"{batch_duration} seconds", available_now)
    if exactly_once_file_sink:
        return st.start_file_sink(enriched, output_dir, checkpoint, ENRICH_PARTITIONS, trigger=trigger)
    return st.start_batch_sink(enriched, output_dir, checkpoint, "append", ENRICH_PARTITIONS,
                               trigger=trigger, on_batch=on_batch)
