import json
import os
import time
from datetime import datetime

from pyspark.sql import functions as F

from tradewind import streaming as st
from tradewind.schemas import MESSAGE_SCHEMA

BATCHES = [
    [("B", 1, "2026-08-01T08:00:10"), ("B", 2, "2026-08-01T08:00:50"), ("O", 3, "2026-08-01T08:01:05"),
     (None, 4, "2026-08-01T08:01:10"), ("NULL_ID", 9, "2026-08-01T08:01:00"), ("B", 9, None)],
    [("B", 4, "2026-08-01T08:05:00"), ("B", 5, "2026-08-01T08:00:20")],
    [("B", 6, "2026-08-01T08:00:30"), ("B", 7, "2026-08-01T08:03:30")],
    [("B", 1, "2026-08-01T08:02:59.999"), ("B", 1, "2026-08-01T08:03:00")],
]


def _message(i, exchange, amount, ts):
    rec = {"trade_id": f"T{i}", "exchange": exchange, "amount_usd": float(amount), "event_time": ts}
    if exchange == "NULL_ID":
        rec = {"exchange": "B", "amount_usd": float(amount), "event_time": ts}
    return (None, json.dumps(rec))


def _write_batches(spark, base):
    """One file per batch, modification times in batch order."""
    n = 0
    for b, rows in enumerate(BATCHES):
        tmp = os.path.join(base, f"_staging{b}")
        msgs = []
        for r in rows:
            msgs.append(_message(n, *r))
            n += 1
        spark.createDataFrame(msgs, MESSAGE_SCHEMA).coalesce(1).write.parquet(tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        dest = os.path.join(base, "log", f"batch{b}.parquet")
        os.makedirs(os.path.dirname(dest), exist_ok=True)
        os.replace(os.path.join(tmp, part), dest)
        t = time.time() - 1000 + b * 10
        os.utime(dest, (t, t))
    return os.path.join(base, "log")


def _move_commit_away(commits, batch, tmp_path):
    """Simulate a crash after the batch's data was written but before its
    commit marker (and the marker's checksum file) landed."""
    for name in (str(batch), f".{batch}.crc"):
        src = os.path.join(commits, name)
        if os.path.exists(src):
            os.replace(src, str(tmp_path / f"moved-{name.lstrip('.')}"))


def _hm(ts):
    return ts.strftime("%H:%M")


def test_lateness_golden(spark, tmp_path):
    log = _write_batches(spark, str(tmp_path))
    agg = st.trade_windows(st.read_message_stream(spark, log, max_files_per_trigger=1))
    outputs = []

    def collect(df, batch_id):
        rows = [(_hm(r.window.start), r.exchange, r.trade_count, r.total_volume) for r in df.collect()]
        if rows:
            outputs.append(rows)

    q = (agg.writeStream.outputMode("update").foreachBatch(collect)
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    st.run_until_done(q)
    key = lambda r: (r[0], r[1] or "")
    assert [sorted(o, key=key) for o in outputs] == [
        [("08:00", "B", 2, 3.0), ("08:01", None, 1, 4.0), ("08:01", "O", 1, 3.0)],
        [("08:00", "B", 3, 8.0), ("08:05", "B", 1, 4.0)],
        [("08:00", "B", 4, 14.0), ("08:03", "B", 1, 7.0)],
        [("08:03", "B", 2, 8.0)],
    ]


def test_stream_equals_batch_update_and_complete(spark, tmp_path):
    from tradewind.operators import generate as gen
    from tradewind.operators import encode_trades
    trades = gen.stream_trades(spark.range(0, 3000, 1, 4))
    log = str(tmp_path / "log")
    # Four appends in event-time order: one file per micro-batch, no late rows.
    for k in range(4):
        part = gen.stream_trades(spark.range(k * 750, (k + 1) * 750, 1, 1))
        st.write_message_log(encode_trades(part), log)
        time.sleep(0.05)
    batch = st.flatten_window(st.windowed_trade_stats(st.with_event_time(trades), watermark=None))
    expected = sorted(tuple(r) for r in batch.collect())

    out, ck = str(tmp_path / "upd"), str(tmp_path / "ck1")
    agg = st.trade_windows(st.read_message_stream(spark, log, max_files_per_trigger=1))
    st.run_until_done(st.start_batch_sink(agg, out, ck, "update", trigger={"availableNow": True}))
    got = st.flatten_window(st.last_wins(spark.read.parquet(out), ["window", "exchange"]))
    assert sorted(tuple(r) for r in got.select(*batch.columns).collect()) == expected

    out2, ck2 = str(tmp_path / "cmp"), str(tmp_path / "ck2")
    agg2 = st.trade_windows(st.read_message_stream(spark, log, max_files_per_trigger=1), sort=True)
    st.run_until_done(st.start_batch_sink(agg2, out2, ck2, "complete", trigger={"availableNow": True}))
    got2 = st.flatten_window(st.latest_batch(spark.read.parquet(out2)))
    assert sorted(tuple(r) for r in got2.select(*batch.columns).collect()) == expected


def test_update_mode_rejects_sort(spark, tmp_path):
    log = _write_batches(spark, str(tmp_path))
    agg = st.trade_windows(st.read_message_stream(spark, log), sort=True)
    import pytest
    with pytest.raises(Exception):
        q = (agg.writeStream.outputMode("update").format("noop")
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        st.run_until_done(q)


def test_foreach_batch_replay_is_idempotent(spark, tmp_path):
    from tradewind.operators import encode_transactions
    from tradewind.operators.generate import synthetic_transactions
    log = str(tmp_path / "log")
    for k in range(2):  # two files -> two batches
        st.write_message_log(encode_transactions(synthetic_transactions(spark.range(k * 100, k * 100 + 100, 1, 1))), log)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    counts = {}

    def run():
        s = st.enriched_transaction_stream(st.read_message_stream(spark, log, max_files_per_trigger=1))
        st.run_until_done(st.start_batch_sink(s, out, ck, "append", ["day_of_week", "amount_category"],
                                              trigger={"availableNow": True},
                                              on_batch=lambda b, n: counts.__setitem__(b, n)))

    run()
    assert spark.read.parquet(out).count() == 200
    commits = os.path.join(ck, "commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    _move_commit_away(commits, last, tmp_path)
    run()                           # Spark replays the uncommitted batch
    assert spark.read.parquet(out).count() == 200
    assert sum(counts.values()) >= 200 and counts[last] == 100


def test_file_sink_replay_is_idempotent(spark, tmp_path):
    from tradewind.operators import encode_transactions
    from tradewind.operators.generate import synthetic_transactions
    log = str(tmp_path / "log")
    for k in range(2):
        st.write_message_log(encode_transactions(synthetic_transactions(spark.range(k * 50, k * 50 + 50, 1, 1))), log)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        s = st.enriched_transaction_stream(st.read_message_stream(spark, log, max_files_per_trigger=1))
        st.run_until_done(st.start_file_sink(s, out, ck, ["day_of_week", "amount_category"],
                                             trigger={"availableNow": True}))

    run()
    commits = os.path.join(ck, "commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    _move_commit_away(commits, last, tmp_path)
    run()
    back = spark.read.parquet(out)
    assert back.count() == 100
    assert dict(back.dtypes)["day_of_week"] == "int"


def test_ntz_event_time_is_cast_for_watermark(spark):
    df = spark.createDataFrame([(datetime(2026, 8, 1, 8, 0, 5), "B", 1.0)],
                               "event_time timestamp_ntz, exchange string, amount_usd double")
    t = st.with_event_time(df)
    assert dict(t.dtypes)["event_timestamp"] == "timestamp"
    r = st.flatten_window(st.windowed_trade_stats(t)).first()
    assert r.window_start == datetime(2026, 8, 1, 8, 0) and r.trade_count == 1
    assert F is not None


def test_table_stream_equals_batch(spark, tmp_path):
    from tradewind.sources import views
    from tests.conftest import SF_SMALL
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = st.read_table_stream(spark, SF_SMALL, "events", events.schema)
    agg = st.windowed_trade_stats(st.with_event_time(views.trades_from_events(stream), "event_time"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    st.run_until_done(st.start_batch_sink(agg, out, ck, "update", trigger={"availableNow": True},
                                          state_partitions=4))
    got = st.flatten_window(st.last_wins(spark.read.parquet(out), ["window", "exchange"]))
    batch = st.flatten_window(st.windowed_trade_stats(
        st.with_event_time(views.trades_from_events(events), "event_time"), watermark=None))
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted(map(tuple, got.select(*batch.columns).collect()), key=key) == \
        sorted(map(tuple, batch.collect()), key=key)


def _run_modes(spark, tmp_path, mode):
    log = _write_batches(spark, str(tmp_path / mode))
    agg = st.trade_windows(st.read_message_stream(spark, log, max_files_per_trigger=1),
                           sort=(mode == "complete"))
    outputs = []

    def collect(df, batch_id):
        rows = [(_hm(r.window.start), r.exchange, r.trade_count, r.total_volume) for r in df.collect()]
        if rows:
            outputs.append(sorted(rows, key=lambda r: (r[0], r[1] or "")))

    q = (agg.writeStream.outputMode(mode).foreachBatch(collect)
         .option("checkpointLocation", str(tmp_path / f"ck-{mode}")).trigger(availableNow=True).start())
    st.run_until_done(q)
    return outputs


def test_lateness_golden_append(spark, tmp_path):
    assert _run_modes(spark, tmp_path, "append") == [
        [("08:00", "B", 4, 14.0), ("08:01", None, 1, 4.0), ("08:01", "O", 1, 3.0)],
    ]


def test_lateness_golden_complete_keeps_late_rows(spark, tmp_path):
    outs = _run_modes(spark, tmp_path, "complete")
    assert [len(o) for o in outs[:4]] == [3, 4, 5, 6]
    assert ("08:02", "B", 1, 1.0) in outs[3]       # the late row is kept
    assert ("08:00", "B", 4, 14.0) in outs[3]


def test_rocksdb_state_store_same_result(spark, tmp_path):
    from tradewind.operators import generate as gen
    from tradewind.operators import encode_trades
    from tradewind.session import STREAMING_SCALE_CONF, session_conf
    log = str(tmp_path / "log")
    for k in range(3):
        st.write_message_log(encode_trades(gen.stream_trades(spark.range(k * 400, (k + 1) * 400, 1, 1))), log)
        time.sleep(0.05)
    results = []
    for name, conf in (("default", {}), ("rocksdb", STREAMING_SCALE_CONF)):
        out, ck = str(tmp_path / f"out-{name}"), str(tmp_path / f"ck-{name}")
        agg = st.trade_windows(st.read_message_stream(spark, log, max_files_per_trigger=1))
        with session_conf(spark, conf):
            q = st.start_batch_sink(agg, out, ck, "update", trigger={"availableNow": True}, state_partitions=4)
        st.run_until_done(q)
        got = st.flatten_window(st.last_wins(spark.read.parquet(out), ["window", "exchange"]))
        results.append(sorted(map(tuple, got.collect())))
    assert results[0] == results[1] and len(results[0]) > 0

    def state_files(name):
        return {f.rsplit(".", 1)[-1] for _, _, fs in os.walk(str(tmp_path / f"ck-{name}" / "state"))
                for f in fs if "." in f}
    assert "delta" in state_files("default")
    assert state_files("rocksdb") & {"changelog", "zip"}
