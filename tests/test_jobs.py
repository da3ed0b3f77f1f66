"""The end-to-end jobs on generated inputs."""
from pyspark.sql import functions as F

from tradewind import sinks
from tradewind import streaming as st
from tradewind.operators import encode_trades, encode_transactions
from tradewind.operators import generate as gen
from tradewind.plans import jobs
from tradewind.schemas import TRANSACTION_RAW_NAMES


def test_trade_batch_golden(spark, tmp_path):
    csv = str(tmp_path / "trades_csv")
    sinks.write_csv(gen.sample_trades(spark.range(0, 2000, 1, 4)), csv)
    out = jobs.trade_batch(spark, csv, str(tmp_path / "by_exchange"))
    q = out["quality"].first()
    assert (q.original_rows, q.cleaned_rows, q.removed_rows, q.null_amount_usd, q.null_exchange) == \
        (2000, 1976, 24, 15, 10)
    stored = out["stored_stats"].collect()
    assert len(stored) == 5 and stored[0].written_rows == 5
    s = out["summary"].first()
    assert (s.total_trades, s.cleaned_trades) == (2000, 1976)
    assert s.top_exchange == out["exchange_stats"].first().exchange
    matched = out["joined"].filter(F.col("trader_name").isNotNull()).count()
    assert matched + out["unmatched"].count() == 1976


def test_transaction_batch_and_summary(spark, tmp_path):
    csv = str(tmp_path / "raw_csv")
    raw_names = [k for k, v in TRANSACTION_RAW_NAMES.items() if v != "kafka_timestamp"]
    sinks.write_csv(gen.synthetic_transactions(spark.range(0, 3000, 1, 3)).toDF(*raw_names), csv)
    out = jobs.transaction_batch(spark, csv, str(tmp_path / "processed"))
    assert out["enriched"].count() == 3000
    assert sum(r["count"] for r in out["tier_stats"].collect()) == 3000
    summary = jobs.transaction_summary(spark, str(tmp_path / "processed"))
    assert summary["total"].first().row_count == 3000
    assert abs(sum(r.pct for r in summary["laundering_share"].collect()) - 100.0) < 1e-9
    assert len(summary["hour_stats"].collect()) <= 25


def test_transaction_stream_then_summary(spark, tmp_path):
    log = str(tmp_path / "log")
    for k in range(3):
        st.write_message_log(encode_transactions(gen.synthetic_transactions(spark.range(k * 500, (k + 1) * 500, 1, 1))), log)
    out = str(tmp_path / "processed")
    seen = {}
    q = jobs.transaction_stream(spark, out, str(tmp_path / "ck"),
                                messages=st.read_message_stream(spark, log, max_files_per_trigger=1),
                                available_now=True, on_batch=lambda b, n: seen.__setitem__(b, n))
    st.run_until_done(q)
    assert sum(seen.values()) == 1500
    summary = jobs.transaction_summary(spark, out)
    assert summary["total"].first().row_count == 1500
    assert {r.amount_category for r in summary["tier_stats"].collect()} <= {"LOW", "MEDIUM", "HIGH"}


def test_trade_stream_update_to_sink(spark, tmp_path):
    log = str(tmp_path / "log")
    trades = gen.stream_trades(spark.range(0, 1200, 1, 1))
    st.write_message_log(encode_trades(trades), log)
    out = str(tmp_path / "windows")
    q = jobs.trade_stream(spark, str(tmp_path / "ck"), out, messages=st.read_message_stream(spark, log),
                          available_now=True, state_partitions=4)
    st.run_until_done(q)
    got = st.flatten_window(st.last_wins(spark.read.parquet(out), ["window", "exchange"]))
    expected = st.flatten_window(st.windowed_trade_stats(st.with_event_time(trades), watermark=None))
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
