"""Named queries over ordered replays of the tables, and the reports beside them.

Each table is replayed as a log in the order of arrival, in ``BATCHES``
micro-batches, so watermarks, state, commits and restarts work over several
batches. A deployment bounds a batch by ``rows_per_file`` instead.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import functions as F

from .. import operators as ops
from .. import streaming as st
from ..functions.scalars import money_sum, round_money
from ..operators.heavy_hitters import heavy_hitters
from ..operators.selection import exact_percentiles
from ..operators.subtotals import subtotals
from ..session import default_parallelism, remove_path, session_conf, shared_dir
from ..sinks.checksum import verify_contents, write_with_checksum
from ..sources import views
from ..sources.decode import decode_messages
from ..sources.offsets import lost_ranges

BATCHES = 12
ROWS_PER_TASK = 1_000_000  # a larger batch is several files of its log, a larger table more range partitions
AVAILABLE_NOW = st.trigger_options(available_now=True)
CRASH_AT = 5  # batch after whose write the planned crash comes

# Fixed rules of the planted cases; the oracle spells the same ones.
LATE_DAYS = [(7, 8), (11, 2)]      # trade_id % 50 = first arrives that many days late
OUT_OF_ORDER = (3, 90)             # trade_id % 20 = first arrives that many seconds late
REDELIVERY_HOURS, REDELIVERY_WITHIN = 36, "4 days"
SESSION_GAP = "6 hours"
TOPIC_PARTITIONS, LOST_BLOCK, LOST_EVERY = 5, 7, 11
VERSIONS, VERSION_DAYS, LONGEST_VALIDITY = 7, 6, "10 days"
DIMS = ["day_of_week", "hour_of_day", "amount_category", "is_laundering"]
SETS = [DIMS, DIMS[:2], ["day_of_week", "amount_category"], ["amount_category", "is_laundering"], ["is_laundering"], []]
PERCENTILES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


class Log(NamedTuple):
    path: str
    files_per_batch: int


def _log(spark, df, order_by, columns=None, encode=None) -> Log:
    path, rows = shared_dir(spark, "log"), df.count()
    per_batch = max(1, -(-rows // BATCHES))
    split = -(-per_batch // ROWS_PER_TASK)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))
    st.write_replay_log(df, path, order_by, per_batch, columns, encode, split, tasks)
    return Log(path, split)


def _message_log(spark, df, beside) -> Log:
    """The rows as messages in the order of the columns ``beside``, which are not
    part of the messages."""
    return _log(spark, df, beside, ["key", "value"], lambda rows: ops.encode_messages(rows, beside=beside))


def _replay(spark, log: Log):
    return st.read_replay(spark, log.path, log.files_per_batch)


def _finish(spark, start, *logs) -> str:
    """Run a stream over logs to its end; they and the checkpoint go."""
    out, ckpt = shared_dir(spark, "replayed"), shared_dir(spark, "ckpt")
    st.run_until_done(start(out, ckpt))
    for path in (ckpt, *(log.path for log in logs)):
        remove_path(spark, path)
    return out


def _crash_and_finish(spark, start, *logs) -> str:
    """The same with a planned crash: the stream ends with ``Interrupted`` and is
    started again from its checkpoint."""
    out, ckpt = shared_dir(spark, "replayed"), shared_dir(spark, "ckpt")
    try:
        st.run_until_done(start(out, ckpt))
    except Exception as e:
        if st.Interrupted.__name__ not in str(e):
            raise
        st.run_until_done(start(out, ckpt))
    for path in (ckpt, *(log.path for log in logs)):
        remove_path(spark, path)
    return out


def _delayed(trades):
    """Trades with their arrival: some out of order, some days late."""
    delay = F.when(F.col("trade_id") % 20 == OUT_OF_ORDER[0], F.expr(f"INTERVAL {OUT_OF_ORDER[1]} SECONDS")).otherwise(F.expr("INTERVAL 0 SECONDS"))
    for rest, days in LATE_DAYS:
        delay = F.when(F.col("trade_id") % 50 == rest, F.expr(f"INTERVAL {days * 86400} SECONDS")).otherwise(delay)
    return trades.withColumn("arrival", F.col("event_time") + delay)


def _late_log(spark, sf_dir) -> Log:
    rows = _delayed(views.trades(spark, sf_dir)).withColumn("id", F.col("trade_id"))
    return _message_log(spark, rows, ["arrival", "id"])


def _ordered_log(spark, sf_dir) -> Log:
    rows = views.trades(spark, sf_dir).withColumns({"arrival": F.col("event_time"), "id": F.col("trade_id")})
    return _message_log(spark, rows, ["arrival", "id"])


def _window_totals(changelog):
    totals = st.flatten_window(st.last_wins(changelog, ["window", "exchange"]))
    return totals.withColumn("total_volume", round_money("total_volume"))


def late_windows(spark, sf_dir):
    """T6 over several batches: trades that arrive late are counted as long as
    the watermark has not closed their window, and dropped after. Beside the
    stream's result: how many trades of the window arrived, how many were dropped."""
    log = _late_log(spark, sf_dir)
    agg = st.trade_windows(_replay(spark, log))
    out = _finish(spark, lambda o, c: st.start_batch_sink(agg, o, c, "update", trigger=AVAILABLE_NOW,
                                                          state_partitions=default_parallelism(spark)), log)
    counted = _window_totals(spark.read.parquet(out))
    every = st.flatten_window(st.windowed_trade_stats(st.with_event_time(views.trades(spark, sf_dir)), watermark=None))
    arrived = every.select(*[F.col(c).alias(f"_{c}") for c in ("window_start", "window_end", "exchange")], F.col("trade_count").alias("arrived"))
    same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in ("window_start", "exchange")]
    n = F.coalesce("trade_count", F.lit(0).cast("long"))
    return arrived.join(counted, same, "left").select(
        F.col("_window_start").alias("window_start"), F.col("_window_end").alias("window_end"), F.col("_exchange").alias("exchange"),
        n.alias("trade_count"), "total_volume", "arrived", (F.col("arrived") - n).alias("dropped"))


def restarted_windows(spark, sf_dir):
    """The late log again; the stream dies after batch 5 has been written
    and before it is recorded as done, and is started again. State, watermark
    and output come back as they were."""
    log = _late_log(spark, sf_dir)
    agg = st.trade_windows(_replay(spark, log))
    writers = {}

    def start(out, ckpt):
        write = writers.setdefault(out, st.crash_once(st.batch_writer(out), CRASH_AT))
        return st.start_foreach(agg, write, ckpt, "update", AVAILABLE_NOW, default_parallelism(spark))
    return _window_totals(spark.read.parquet(_crash_and_finish(spark, start, log)))


def distinct_trades(spark, sf_dir):
    """Redelivered messages: every trade is sent one to three times, copies 36
    hours apart, and comes out once. State holds the keys of four days."""
    copies = F.explode(F.sequence(F.lit(0), (F.col("trade_id") % 3).cast("int")))
    trades = views.trades(spark, sf_dir)
    sent = trades.withColumn("copy", copies).withColumn("arrival", F.col("event_time") + F.make_dt_interval(F.lit(0), F.col("copy") * REDELIVERY_HOURS))
    rows = sent.withColumn("id", F.col("trade_id"))
    log = _message_log(spark, rows.drop("copy"), ["arrival", "id"])
    stream = st.with_event_time(decode_messages(_replay(spark, log), trades.schema, "trade_id"))
    once = st.distinct_messages(stream, ["trade_id"], within=REDELIVERY_WITHIN).drop("event_timestamp")
    out = _finish(spark, lambda o, c: st.start_file_sink(once, o, c, trigger=AVAILABLE_NOW, state_partitions=default_parallelism(spark)), log)
    return spark.read.parquet(out)


def committed_transactions(spark, sf_dir):
    """K3 / T9 with a manifest a batch: enriched transactions in batches; a crash
    between a batch's write and its commit leaves data that no manifest names,
    and the restart writes it again. Read through the manifests."""
    rows = views.transactions(spark, sf_dir)
    log = _log(spark, rows, [F.xxhash64(*rows.columns)], ["key", "value"], ops.encode_transactions)
    stream = st.enriched_transaction_stream(_replay(spark, log))
    left = [CRASH_AT]

    def start(out, ckpt):
        write = st.committed_writer(out, ["day_of_week", "amount_category"], lambda n: st.interrupt(left, n))
        return st.start_foreach(stream, write, ckpt, "append", AVAILABLE_NOW)
    out = _crash_and_finish(spark, start, log)
    return st.read_committed(spark, out).drop("processing_time", "kafka_timestamp")


def window_snapshot(spark, sf_dir):
    """T4: the update-mode changelog of 12 batches folded into one row a window
    and exchange, by rewriting only the buckets (days modulo 16) that a batch
    touches; with a crash between a batch's write and its commit."""
    log = _ordered_log(spark, sf_dir)
    agg = st.flatten_window(st.trade_windows(_replay(spark, log)))
    day = F.pmod(F.datediff(F.col("window_start"), F.lit("1970-01-01").cast("date")), F.lit(16))
    left = [CRASH_AT]

    def start(out, ckpt):
        write = st.snapshot_writer(out, ["window_start", "window_end", "exchange"], day, lambda n: st.interrupt(left, n))
        return st.start_foreach(agg, write, ckpt, "update", AVAILABLE_NOW, default_parallelism(spark))
    out = _crash_and_finish(spark, start, log)
    table = st.read_snapshot(spark, out, agg.schema)
    return table.withColumn("total_volume", round_money("total_volume"))


def lost_offsets(spark, sf_dir):
    """Trades as a topic of 5 partitions, of which retention took every
    11th block of 7 offsets and of which some came twice; the lost ranges."""
    t = views.trades(spark, sf_dir)
    log = t.select((F.col("trade_id") % TOPIC_PARTITIONS).alias("partition"), F.expr(f"trade_id div {TOPIC_PARTITIONS}").alias("offset"))
    kept = log.where(F.expr(f"(offset div {LOST_BLOCK}) % {LOST_EVERY} <> 3"))
    return lost_ranges(kept.unionByName(kept.where("offset % 13 = 0")))


def trader_sessions(spark, sf_dir):
    """Session windows per trader (6 hours apart) as a stream in append mode: the
    sessions that the watermark has closed."""
    log = _ordered_log(spark, sf_dir)
    stream = st.with_event_time(decode_messages(_replay(spark, log), views.trades(spark, sf_dir).schema, "trade_id"))
    found = st.trader_sessions(stream, SESSION_GAP)
    with session_conf(spark, st.SESSION_CONF):
        out = _finish(spark, lambda o, c: st.start_file_sink(found, o, c, trigger=AVAILABLE_NOW, state_partitions=default_parallelism(spark)), log)
    return spark.read.parquet(out).withColumn("total_volume", round_money("total_volume"))


def _trader_versions(spark, sf_dir):
    """Seven versions of every customer's risk level, about six days apart."""
    k, v = F.col("trader_id"), F.col("version")
    rows = views.traders(spark, sf_dir, keys=None).select("trader_id", F.explode(F.sequence(F.lit(0), F.lit(VERSIONS - 1))).alias("version"))
    hours = v * (24 * VERSION_DAYS) + (k * 7 + v * 13) % 48
    rows = rows.withColumn("valid_from", F.lit("2023-12-24").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours.cast("int")))
    level = F.element_at(F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")), ((k + v) % 3 + 1).cast("int"))
    return st.validity(rows.withColumn("risk_level", level), "trader_id", "valid_from", LONGEST_VALIDITY)


def versioned_traders(spark, sf_dir):
    """J1 against a lookup that changes: trades and trader versions as two
    streams, each trade with the version that held at its time."""
    times = {"trade_time": F.col("event_time").cast("timestamp"), "id": F.col("trade_id")}
    t = views.trades(spark, sf_dir).withColumns(times)
    v = _trader_versions(spark, sf_dir)
    v = v.withColumns({c: F.col(c).cast("timestamp") for c in ("valid_from", "valid_to")})
    t_log = _log(spark, t, ["event_time", "trade_id"], ["trade_id", "trader_id", "amount_usd", "trade_time"])
    v_log = _log(spark, v, ["valid_from", "trader_id"])
    joined = st.versioned_join(_replay(spark, t_log), _replay(spark, v_log), "trader_id", "trade_time",
                               "valid_from", "valid_to", LONGEST_VALIDITY)
    found = joined.select("trade_id", "trader_id", "amount_usd", "version", "risk_level")
    out = _finish(spark, lambda o, c: st.start_file_sink(found, o, c, trigger=AVAILABLE_NOW, state_partitions=default_parallelism(spark)), t_log, v_log)
    return spark.read.parquet(out)


def transaction_subtotals(spark, sf_dir):
    """Grouping sets over weekday, hour, tier and flag in one scan."""
    found = subtotals(ops.enrich_transactions(views.transactions(spark, sf_dir)), DIMS, SETS, "amount_received")
    return found.withColumn("total_amount", round_money("total_amount"))


def tier_percentiles(spark, sf_dir):
    """Exact percentiles of the amount received per tier."""
    rows = ops.enrich_transactions(views.transactions(spark, sf_dir))
    return exact_percentiles(rows, ["amount_category"], "amount_received", PERCENTILES)


def heavy_banks(spark, sf_dir):
    """A10: the 1000 most frequent sending banks by bounded summaries and an exact
    second pass."""
    return heavy_hitters(views.transactions(spark, sf_dir), "from_bank", 1000)


def verified_transactions(spark, sf_dir):
    """K2: every transaction written, read back and compared by contents."""
    t = views.transactions(spark, sf_dir)
    path = shared_dir(spark, "verified")
    return verify_contents(spark, path, t.schema, write_with_checksum(t, path))


STREAM_QUERIES = {f.__name__: f for f in (
    late_windows, restarted_windows, distinct_trades, committed_transactions, window_snapshot, lost_offsets, trader_sessions,
    versioned_traders, transaction_subtotals, tier_percentiles, heavy_banks, verified_transactions)}
