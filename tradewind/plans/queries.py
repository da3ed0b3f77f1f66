"""Named queries over the driver's tables: ``name -> fn(spark, sf_dir)``.

Each query composes the library's operators over the fixture views
(``sources.views``) and returns a DataFrame whose columns match the DuckDB
oracle in ``plans.oracle``. Nothing is collected; queries that need an
intermediate table (CSV/Parquet round trips, stream sinks) write it under
the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..functions.scalars import (format_transaction_time, hex_id, money_sum, padded_id, parse_iso_time,
                                 round_money)
from ..session import default_parallelism, remove_path, session_conf, shared_dir
from ..sinks import files as sinks
from ..sources import files as src
from ..sources import lookup as src_lookup
from ..sources import views
from ..sources.decode import decode_messages, decode_report, decode_transactions
from ..schemas import TRANSACTION_RAW_NAMES as RAW_NAMES, TRANSACTION_WIRE_SCHEMA
from .. import streaming as st
from ..operators import generate as gen

def rounded(df: DataFrame, *money: str) -> DataFrame:
    """Money to 2 places (X16), where two engines' double sums agree."""
    return df.withColumns({c: round_money(c) for c in money})


Query = Callable[[SparkSession, str], DataFrame]


# -- sources -----------------------------------------------------------------

def parquet_scan(spark, sf_dir):
    """The trades view straight off the Parquet scan."""
    return views.trades(spark, sf_dir)


TRADE_CSV_SCHEMA = "trade_id string, exchange string, trader_id string, amount_usd double, event_time string"


def csv_scan(spark, sf_dir):
    """K6 then S1: trades written as CSV (ISO event time, like the
    reference's file), read back with a declared schema."""
    t = views.trades(spark, sf_dir)
    out = t.select(F.col("trade_id").cast("string").alias("trade_id"), "exchange",
                   F.col("trader_id").cast("string").alias("trader_id"), "amount_usd",
                   F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"))
    path = shared_dir(spark, "csv_scan")
    sinks.write_csv(out, path)
    return src.read_csv(spark, path, TRADE_CSV_SCHEMA)


def range_count(spark, sf_dir):
    """A range as long as the events table, counted and summed."""
    n = src.read_table(spark, sf_dir, "events").count()
    return src.id_range(spark, n).agg(F.count(F.lit(1)).alias("row_count"),
                                      F.sum("id").alias("id_sum"))


# -- projections, filters, cleaning -----------------------------------------

def whale_trades(spark, sf_dir):
    """F1 + P1: trades above 100,000, projected to id, exchange, amount."""
    return ops.whale_trades(views.trades(spark, sf_dir))


def null_counts(spark, sf_dir):
    """null amounts and null exchanges in one scan."""
    return ops.null_counts(views.trades(spark, sf_dir), ["amount_usd", "exchange"])


def quality_report(spark, sf_dir):
    """original, cleaned and removed rows plus null counts, one aggregate."""
    return ops.quality_report(views.trades(spark, sf_dir))


def clean_trades(spark, sf_dir):
    """F4 + X3: complete trades with the whale flag."""
    return ops.clean_trades(views.trades(spark, sf_dir))


def filled_trades(spark, sf_dir):
    """string nulls become ''."""
    return ops.fill_nulls(views.trades(spark, sf_dir), "", ["exchange"])


def head_n(spark, sf_dir):
    """the first 10 trades by id."""
    return ops.head(views.trades(spark, sf_dir), 10, "trade_id")


# -- aggregates --------------------------------------------------------------

def exchange_stats(spark, sf_dir):
    """A2 + O1 (flagship): per-exchange count, total, mean, max; largest total first."""
    return rounded(ops.exchange_stats(ops.clean_trades(views.trades(spark, sf_dir))), "total_volume", "avg_trade_size")


def top_exchange(spark, sf_dir):
    """The exchange with the largest cleaned volume."""
    return ops.top_exchange(exchange_stats(spark, sf_dir))


def trade_summary(spark, sf_dir):
    """Total, cleaned and whale trades and the top exchange, one scan."""
    return ops.trade_summary(views.trades(spark, sf_dir))


def trade_count(spark, sf_dir):
    """A1 over trades."""
    return ops.row_count(views.trades(spark, sf_dir))


# -- joins -------------------------------------------------------------------

def trader_join(spark, sf_dir):
    """Cleaned trades left-joined to the five-trader lookup."""
    return ops.lookup_join(ops.clean_trades(views.trades(spark, sf_dir)),
                           views.traders(spark, sf_dir), "trader_id", "left")


def inline_lookup_join(spark, sf_dir):
    """S3 + J1: the lookup is a driver-side list, so it is broadcast."""
    listed = src_lookup.inline_lookup(spark, [(k, f"trader {k}") for k in views.LOOKUP_TRADER_KEYS], "trader_id long, trader_name string")
    return ops.lookup_join(ops.clean_trades(views.trades(spark, sf_dir)), listed, "trader_id", "left", broadcast=True)


def unmatched_trades(spark, sf_dir):
    """Cleaned trades whose trader is not in the lookup (anti join)."""
    return ops.unmatched(ops.clean_trades(views.trades(spark, sf_dir)),
                         views.traders(spark, sf_dir), "trader_id",
                         ["trade_id", "trader_id", "amount_usd"])


def unmatched_trades_full(spark, sf_dir):
    """J2 against a lookup that grows with the data: every customer but each
    third one."""
    lookup = views.traders(spark, sf_dir, keys=None).where("trader_id % 3 <> 0")
    return ops.unmatched(ops.clean_trades(views.trades(spark, sf_dir)), lookup, "trader_id",
                         ["trade_id", "trader_id", "amount_usd"])


def trader_join_full(spark, sf_dir):
    """J1 against every customer, a lookup that grows with the data. The merge
    hint keeps it on the shuffle path at any size, salted as for a hot key."""
    return ops.lookup_join(ops.clean_trades(views.trades(spark, sf_dir)),
                           views.traders(spark, sf_dir, keys=None).hint("merge"), "trader_id", "left", salt_buckets=8)


# -- transactions ------------------------------------------------------------

def enriched(spark, sf_dir) -> DataFrame:
    """The enriched transactions view."""
    return ops.enrich_transactions(views.transactions(spark, sf_dir))


def enriched_transactions(spark, sf_dir):
    """Every transaction enriched."""
    return enriched(spark, sf_dir)


def laundering_counts(spark, sf_dir):
    """A3: rows per laundering flag."""
    return ops.group_count(enriched(spark, sf_dir), "is_laundering")


def laundering_share(spark, sf_dir):
    """A4: rows and percent of all rows per laundering flag."""
    return ops.share_of_total(enriched(spark, sf_dir), "is_laundering")


def tier_stats(spark, sf_dir):
    """A5: count, mean and total amount per tier."""
    return rounded(ops.tier_stats(enriched(spark, sf_dir)), "avg_amount", "total_amount")


def weekday_stats(spark, sf_dir):
    """A6 + O2: count and total amount per weekday, by weekday."""
    return rounded(ops.weekday_stats(enriched(spark, sf_dir)), "total_amount")


def hour_stats(spark, sf_dir):
    """A7 + O2: count per hour, by hour; unparsable times are a group."""
    return ops.hour_stats(enriched(spark, sf_dir))


def amount_describe(spark, sf_dir):
    """A8, typed; mean and stddev rounded to 4 places (cross-engine floats)."""
    s = ops.amount_summary(enriched(spark, sf_dir), "amount_received")
    return s.select("count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
                    "min", "max")


def transaction_count(spark, sf_dir):
    """A1 over transactions."""
    return ops.row_count(views.transactions(spark, sf_dir))


def bank_profile(spark, sf_dir):
    """A10: the 1000 most frequent sending banks."""
    return ops.frequency_profile(views.transactions(spark, sf_dir), "from_bank", 1000)


def currency_profile(spark, sf_dir):
    """A10: receiving currencies by frequency."""
    return ops.frequency_profile(views.transactions(spark, sf_dir), "receiving_currency")


def format_profile(spark, sf_dir):
    """A10: payment formats by frequency."""
    return ops.frequency_profile(views.transactions(spark, sf_dir), "payment_format")


def label_rate(spark, sf_dir):
    """Mean of the 0/1 laundering label."""
    return ops.label_rate(views.transactions(spark, sf_dir))


def laundering_tally(spark, sf_dir):
    """A12 over the transactions view."""
    return ops.flag_tally(views.transactions(spark, sf_dir))


# -- messages ----------------------------------------------------------------

def _binary(messages):
    """Values as Kafka hands them over."""
    return messages.withColumn("value", F.col("value").cast("binary"))


def decoded_messages(spark, sf_dir):
    """M1 then S6: every transaction encoded under the wire's names, decoded
    from binary again; only the presence of the ingest stamp (X17) is kept."""
    msgs = _binary(ops.encode_transactions(views.transactions(spark, sf_dir)))
    decoded = decode_transactions(msgs, keep_columns=["key"])
    stamped = parse_iso_time("kafka_timestamp").isNotNull()
    return decoded.withColumn("stamped", stamped).drop("kafka_timestamp")


def decode_losses(spark, sf_dir):
    """S6 + F3: messages, and those that decode to nothing (here: every
    transaction of a bank divisible by 5 is cut short on the wire)."""
    msgs = ops.encode_transactions(views.transactions(spark, sf_dir))
    broken = F.when(F.col("key").cast("int") % 5 == 0, F.substring("value", 1, 7)).otherwise(F.col("value"))
    return decode_report(msgs.withColumn("value", broken), TRANSACTION_WIRE_SCHEMA, "Timestamp")


def trade_messages(spark, sf_dir):
    """M2 then S6: unkeyed trade messages decoded back to rows."""
    t = views.trades(spark, sf_dir)
    return decode_messages(_binary(ops.encode_trades(t)), t.schema, required="trade_id", keep_columns=["key"])


def formatted_transactions(spark, sf_dir):
    """Time, hex and padded ids and rounded amounts of every
    transaction, and whether a processing time is there."""
    t = ops.enrich_transactions(views.transactions(spark, sf_dir))
    t = ops.with_processing_time(t)
    return t.select(
        "ts", format_transaction_time("event_timestamp").alias("formatted"), hex_id("from_bank").alias("bank_hex"),
        padded_id("BANK", "to_bank", 4).alias("bank_padded"), round_money("amount_received", 0).alias("amount_rounded"),
        F.col("processing_time").isNotNull().alias("processed"))


def schema_listing(spark, sf_dir):
    """Names and types of the enriched transactions, with the number of
    rows that have each."""
    e = enriched(spark, sf_dir)
    kinds = src.schema_report(e)
    counts = e.agg(*[F.count(F.col(n)).alias(n) for n, _ in kinds])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("type"), F.col(n).alias("filled")) for n, k in kinds])
    return counts.select(F.inline(pairs))


def large_lines(spark, sf_dir):
    """F1 on a stored column: the comparison reaches the Parquet reader."""
    lines = src.read_table(spark, sf_dir, "lineitem")
    return ops.whale_trades(lines, "l_extendedprice", 50000, ["l_orderkey", "l_linenumber", "l_extendedprice"])


def top_banks(spark, sf_dir):
    """A10 with a limit that cuts: the 5 most frequent sending banks."""
    return ops.frequency_profile(views.transactions(spark, sf_dir), "from_bank", 5)


def replay_cycles(spark, sf_dir):
    """M3: the trades table replayed three times."""
    return ops.replay_cycles(views.trades(spark, sf_dir), 3)


# -- sinks -------------------------------------------------------------------

def transactions_csv_scan(spark, sf_dir):
    """S1 + K6 for the raw feed: transactions written as CSV under the feed's
    own headers in another order, read back by header name, enriched."""
    raw_names = [k for k, v in RAW_NAMES.items() if v != "kafka_timestamp"]
    path = shared_dir(spark, "transactions_csv")
    t = views.transactions(spark, sf_dir).toDF(*raw_names)
    sinks.write_csv(t.select(*[f"`{c}`" for c in reversed(raw_names)]), path)
    return ops.enrich_transactions(src.read_raw_transactions_csv(spark, path))


def parquet_roundtrip(spark, sf_dir):
    """K1 + K2: exchange statistics written, verified and read back."""
    written, back = sinks.write_and_verify(exchange_stats(spark, sf_dir), shared_dir(spark, "exchange_stats"))
    return back.withColumn("written_rows", F.lit(written).cast("bigint"))


def partitioned_enriched(spark, sf_dir):
    """K3 (batch): enriched transactions partitioned by weekday and tier,
    read back (partition columns come last)."""
    path = shared_dir(spark, "enriched_partitioned")
    sinks.write_partitioned(enriched(spark, sf_dir), path, ["day_of_week", "amount_category"])
    return sinks.read_partitioned(spark, path)


# -- event-time windows and streams -------------------------------------------

ENRICH_PARTITIONS = ["day_of_week", "amount_category"]
# A row of a table's file is some 40 times as large as a message: a split of the
# default 128 MB would be minutes of one task, and a few of them leave cores idle.
STREAM_SPLITS = {"spark.sql.files.maxPartitionBytes": str(16 << 20)}
AVAILABLE_NOW = st.trigger_options(available_now=True)


def windowed_trades_batch(spark, sf_dir):
    """T2 + T3 on the batch frame."""
    t = st.with_event_time(views.trades(spark, sf_dir), "event_time")
    return rounded(st.flatten_window(st.windowed_trade_stats(t, watermark=None)), "total_volume")


def _trade_stream(spark, sf_dir):
    """The events table streamed in place, as trade messages (M2). One batch:
    the table's files are not in event-time order."""
    return _binary(ops.encode_trades(views.trades_from_events(st.read_table_stream(spark, sf_dir, "events"))))


def _transaction_stream(spark, sf_dir, max_files_per_trigger: int = 64):
    """The lineitem table streamed in place, as transaction messages (M1)."""
    lines = st.read_table_stream(spark, sf_dir, "lineitem", max_files_per_trigger=max_files_per_trigger)
    return _binary(ops.encode_transactions(views.transactions_from_lineitem(lines)))


def _run(spark, start) -> str:
    """Run a stream to its end; its checkpoint goes, its output folder stays."""
    out, ckpt = shared_dir(spark, "stream"), shared_dir(spark, "ckpt")
    with session_conf(spark, STREAM_SPLITS):
        query = start(out, ckpt)
    st.run_until_done(query)
    remove_path(spark, ckpt)
    return out


def windowed_trades_stream(spark, sf_dir):
    """Decode -> watermark -> windows, update mode into a
    foreachBatch changelog, read back last-wins per (window, exchange)."""
    agg = st.trade_windows(_trade_stream(spark, sf_dir))
    out = _run(spark, lambda o, c: st.start_batch_sink(agg, o, c, "update", trigger=AVAILABLE_NOW,
                                                       state_partitions=default_parallelism(spark)))
    return rounded(st.flatten_window(st.last_wins(spark.read.parquet(out), ["window", "exchange"])), "total_volume")


def windowed_trades_complete(spark, sf_dir):
    """T5 (b): complete mode; the last batch holds the whole result, sorted by
    window when it is read (files keep no order). For bounded input: complete
    mode holds every window."""
    agg = st.trade_windows(_trade_stream(spark, sf_dir))
    out = _run(spark, lambda o, c: st.start_batch_sink(agg, o, c, "complete", trigger=AVAILABLE_NOW,
                                                       state_partitions=default_parallelism(spark)))
    latest = st.flatten_window(st.latest_batch(spark.read.parquet(out)))
    return rounded(latest, "total_volume").orderBy("window_start", "exchange")


def windowed_trades_append(spark, sf_dir):
    """Append mode into the exactly-once file sink -- only windows the
    watermark has closed (end <= max event time - 2 minutes) are emitted; those
    still open at the end are left out, as append mode does."""
    agg = st.trade_windows(_trade_stream(spark, sf_dir))
    out = _run(spark, lambda o, c: st.start_file_sink(agg, o, c, trigger=AVAILABLE_NOW,
                                                      state_partitions=default_parallelism(spark)))
    return rounded(st.flatten_window(spark.read.parquet(out)), "total_volume")


def _enriched_sink(spark, sf_dir) -> str:
    stream = st.enriched_transaction_stream(_transaction_stream(spark, sf_dir))
    return _run(spark, lambda o, c: st.start_file_sink(stream, o, c, ENRICH_PARTITIONS, trigger=AVAILABLE_NOW))


def stream_enrich_sink(spark, sf_dir):
    """T10 + K3: transaction messages -> decode -> enrich -> Parquet
    partitioned by weekday and tier through the exactly-once file sink."""
    return spark.read.parquet(_enriched_sink(spark, sf_dir)).drop("processing_time", "kafka_timestamp")


def stream_summary(spark, sf_dir):
    """The summary job over the stream sink's partitioned output, all of it:
    rows and total amount by weekday and tier."""
    stored = spark.read.parquet(_enriched_sink(spark, sf_dir))
    return (stored.groupBy("day_of_week", "amount_category")
            .agg(F.count(F.lit(1)).alias("count"), round_money(money_sum("amount_received")).alias("total_amount")))


def stream_enrich_batches(spark, sf_dir):
    """T9 + K3: the same stream through foreachBatch, each micro-batch in its
    own replay-safe batch_id folder, then folded into one table."""
    stream = st.enriched_transaction_stream(_transaction_stream(spark, sf_dir, max_files_per_trigger=2))
    out = _run(spark, lambda o, c: st.start_batch_sink(stream, o, c, "append", ENRICH_PARTITIONS, trigger=AVAILABLE_NOW))
    table = st.compact_batches(spark, out, shared_dir(spark, "enriched"), ENRICH_PARTITIONS)
    remove_path(spark, out)
    return table.drop("processing_time", "kafka_timestamp")


def generated_trade_windows(spark, sf_dir):
    """G2 -> M2 -> trade stream (update mode) -> last-wins windows."""
    ids = st.read_table_stream(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    agg = st.trade_windows(_binary(ops.encode_trades(gen.stream_trades(ids))))
    out = _run(spark, lambda o, c: st.start_batch_sink(agg, o, c, "update", trigger=AVAILABLE_NOW,
                                                       state_partitions=default_parallelism(spark)))
    return rounded(st.flatten_window(st.last_wins(spark.read.parquet(out), ["window", "exchange"])), "total_volume")


# -- generators ---------------------------------------------------------------

def _event_ids(spark, sf_dir):
    return src.read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))


def _order_ids(spark, sf_dir):
    return src.read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))


def generated_trades(spark, sf_dir):
    """G1: one sample trade per event id."""
    return gen.sample_trades(_event_ids(spark, sf_dir))


def generated_stream_trades(spark, sf_dir):
    """One stream-shaped trade per event id."""
    return gen.stream_trades(_event_ids(spark, sf_dir))


def synthetic_transactions(spark, sf_dir):
    """One fixed-domain transaction per order key."""
    return gen.synthetic_transactions(_order_ids(spark, sf_dir))


def synthetic_tally(spark, sf_dir):
    """A12 over G3: sent, flagged, flagged percent."""
    return ops.flag_tally(gen.synthetic_transactions(_order_ids(spark, sf_dir)))


def profiled_transactions(spark, sf_dir):
    """One transaction per order key, drawn from the transactions
    view's profile (top-1000 banks, currencies, formats, label rate)."""
    return gen.profiled_transactions(_order_ids(spark, sf_dir), views.transactions(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "parquet_scan": parquet_scan,
    "csv_scan": csv_scan,
    "range_count": range_count,
    "whale_trades": whale_trades,
    "null_counts": null_counts,
    "quality_report": quality_report,
    "clean_trades": clean_trades,
    "filled_trades": filled_trades,
    "head_n": head_n,
    "exchange_stats": exchange_stats,
    "top_exchange": top_exchange,
    "trade_summary": trade_summary,
    "trade_count": trade_count,
    "trader_join": trader_join,
    "inline_lookup_join": inline_lookup_join,
    "unmatched_trades_full": unmatched_trades_full,
    "decode_losses": decode_losses,
    "formatted_transactions": formatted_transactions,
    "schema_listing": schema_listing,
    "large_lines": large_lines,
    "top_banks": top_banks,
    "unmatched_trades": unmatched_trades,
    "trader_join_full": trader_join_full,
    "enriched_transactions": enriched_transactions,
    "laundering_counts": laundering_counts,
    "laundering_share": laundering_share,
    "tier_stats": tier_stats,
    "weekday_stats": weekday_stats,
    "hour_stats": hour_stats,
    "amount_describe": amount_describe,
    "transaction_count": transaction_count,
    "bank_profile": bank_profile,
    "currency_profile": currency_profile,
    "format_profile": format_profile,
    "label_rate": label_rate,
    "laundering_tally": laundering_tally,
    "decoded_messages": decoded_messages,
    "trade_messages": trade_messages,
    "replay_cycles": replay_cycles,
    "transactions_csv_scan": transactions_csv_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "partitioned_enriched": partitioned_enriched,
    "windowed_trades_batch": windowed_trades_batch,
    "windowed_trades_stream": windowed_trades_stream,
    "windowed_trades_complete": windowed_trades_complete,
    "windowed_trades_append": windowed_trades_append,
    "stream_enrich_sink": stream_enrich_sink,
    "stream_enrich_batches": stream_enrich_batches,
    "stream_summary": stream_summary,
    "generated_trade_windows": generated_trade_windows,
    "generated_trades": generated_trades,
    "generated_stream_trades": generated_stream_trades,
    "synthetic_transactions": synthetic_transactions,
    "synthetic_tally": synthetic_tally,
    "profiled_transactions": profiled_transactions,
}
