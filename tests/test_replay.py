"""Ordered replay, redelivered messages, sessions and versioned lookups as streams."""
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tradewind import streaming as st

NOW = st.trigger_options(available_now=True)


def _files(path):
    return sorted(glob.glob(os.path.join(path, "part-*.parquet")))


def test_log_files_are_ordered_bounded_and_complete(spark, tmp_path):
    df = spark.range(0, 1003, 1, 7).select(F.col("id"), ((F.col("id") * 7919) % 1003).alias("at"), F.lit("x").alias("_file"))
    path = str(tmp_path / "log")
    n = st.write_replay_log(df, path, ["at"], 100, ["at", "_file"])
    files = _files(path)
    assert n == len(files) == 11
    parts = [[r.at for r in spark.read.parquet(f).collect()] for f in files]
    assert [x for p in parts for x in p] == list(range(1003)) and [len(p) for p in parts] == [100] * 10 + [3]
    times = [os.path.getmtime(f) for f in files]
    assert times == sorted(times) and len(set(times)) == 11
    seen = []
    q = (st.read_replay(spark, path, 2).writeStream.foreachBatch(lambda d, i: seen.append(sorted(r.at for r in d.collect())))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(**NOW).start())
    st.run_until_done(q)
    assert [(b[0], b[-1], len(b)) for b in seen] == [(200 * k, min(200 * k + 199, 1002), min(200, 1003 - 200 * k)) for k in range(6)]


def test_log_of_equal_keys_and_of_nothing(spark, tmp_path):
    same = spark.range(50).select(F.lit(1).alias("at"), "id")
    assert st.write_replay_log(same, str(tmp_path / "a"), ["at"], 20) == 3
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "a")).collect()) == list(range(50))
    assert st.write_replay_log(same.limit(0), str(tmp_path / "b"), ["at"], 20) == 0
    assert spark.read.parquet(str(tmp_path / "b")).columns == ["at", "id"]
    with pytest.raises(ValueError):
        st.write_replay_log(same, str(tmp_path / "c"), ["at"], 0)


def test_log_splits_batches_and_encodes_ordered_rows(spark, tmp_path):
    """Ties, nulls and equal rows over the borders of files; messages are made after the shuffle."""
    at = F.when(F.col("id") % 7 > 2, F.lit(5)).when(F.col("id") % 7 > 0, F.col("id") % 400)
    df = spark.range(0, 1003, 1, 7).select(at.alias("at"), (F.col("id") % 2).alias("b"), F.lit(1).alias("same"))
    want = sorted(((r.at, r.b) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for order, k in ((["at", "b"], 2), ([F.col("at") + 0], 1)):
        path = str(tmp_path / f"log{k}")
        n = st.write_replay_log(df, path, order, 100, ["m"], lambda rows: rows.select(F.struct("at", "b").alias("m")), split=3, tasks=4)
        parts = [[tuple(r.m) for r in spark.read.parquet(f).collect()] for f in _files(path)]
        assert n == len(parts) == 31 and [len(p) for p in parts] == [34, 33, 33] * 10 + [3]
        assert [r[:k] for p in parts for r in p] == [r[:k] for r in want]
        assert sorted((r for p in parts for r in p), key=repr) == sorted(want, key=repr)
    n = st.write_replay_log(df.select("same"), str(tmp_path / "equal"), ["same"], 250, split=2)
    assert [spark.read.parquet(f).count() for f in _files(str(tmp_path / "equal"))] == [125] * 8 + [3] and n == 9
    with pytest.raises(ValueError):
        st.write_replay_log(df, str(tmp_path / "c"), ["at"], 2, split=3)


def _minute(m):
    return dt.datetime(2026, 8, 1, 8) + dt.timedelta(minutes=m)


def test_redelivery_state_is_bounded(spark, tmp_path):
    # 40 messages a minute apart; every one comes again 3 minutes later, every
    # fourth also 30 minutes later (late by then).
    rows = [(k, _minute(k), k + again) for k in range(40) for again in (0, 3, *([30] if k % 4 == 0 else []))] + [(99, None, 5)]
    log = str(tmp_path / "log")
    st.write_replay_log(spark.createDataFrame(rows, "id long, event_timestamp timestamp, at int"), log, ["at"], 4)
    once = st.distinct_messages(st.read_replay(spark, log), ["id"], within="5 minutes")
    out = []
    q = (once.writeStream.foreachBatch(lambda d, i: out.extend(r.id for r in d.collect())).outputMode("append")
         .option("checkpointLocation", str(tmp_path / "c")).trigger(**NOW).start())
    st.run_until_done(q)
    assert sorted(out) == list(range(40))
    held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(held) < 25, held
    batch = spark.createDataFrame(rows, "id long, event_timestamp timestamp, at int")
    assert st.distinct_messages(batch, ["id"]).count() == 40


def test_sessions_as_batch(spark):
    rows = [(1, _minute(0), 1.0), (1, _minute(9), 2.0), (1, _minute(19), None), (1, _minute(40), 4.0), (2, _minute(9), 8.0), (None, _minute(1), 1.0), (2, None, 1.0)]
    df = spark.createDataFrame(rows, "trader_id long, event_timestamp timestamp, amount_usd double")
    got = sorted([tuple(r) for r in st.trader_sessions(df, "10 minutes").collect()], key=repr)
    # Ten minutes apart is the same session, as the end of one touches the next.
    assert got == sorted([(1, _minute(0), _minute(29), 3, 3.0), (1, _minute(40), _minute(50), 1, 4.0),
                          (2, _minute(9), _minute(19), 1, 8.0), (None, _minute(1), _minute(11), 1, 1.0)], key=repr)


def test_versions_as_batch(spark):
    v = spark.createDataFrame([(1, _minute(0), "a"), (1, _minute(10), "b"), (2, _minute(5), "c")], "trader_id long, valid_from timestamp, level string")
    v = st.validity(v, "trader_id", "valid_from", "20 MINUTES")
    t = spark.createDataFrame([(1, _minute(0)), (1, _minute(9)), (1, _minute(10)), (1, _minute(30)), (2, _minute(4)), (2, _minute(5)), (None, _minute(5))],
                              "trader_id long, at timestamp")
    got = st.versioned_join(t, v, "trader_id", "at", "valid_from", "valid_to", "20 MINUTES")
    assert sorted((r.trader_id, r["at"], r.level) for r in got.collect()) == [
        (1, _minute(0), "a"), (1, _minute(9), "a"), (1, _minute(10), "b"), (2, _minute(5), "c")]
