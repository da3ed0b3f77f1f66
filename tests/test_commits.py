"""Manifest commits: what is not committed is invisible, and a restart loses nothing."""
import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from tradewind import streaming as st

NOW = st.trigger_options(available_now=True)


def _rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_uncommitted_attempt_is_invisible_and_replay_is_exact(spark, tmp_path):
    path = str(tmp_path / "t")
    left = [1]
    write = st.committed_writer(path, ["k"], lambda n: st.interrupt(left, n))
    batch = lambda lo, hi: spark.range(lo, hi).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"))
    write(batch(0, 10), 0)
    with pytest.raises(st.Interrupted):
        write(batch(10, 20), 1)
    assert st.committed(spark, path) == [0]
    assert _rows(st.read_committed(spark, path).select("id")) == [(i,) for i in range(10)]
    write(batch(10, 20), 1)      # the restart
    write(batch(100, 200), 1)    # a batch that is committed already does nothing
    write(batch(0, 0), 2)        # an empty one
    assert st.committed(spark, path) == [0, 1, 2]
    assert sorted(r.id for r in st.read_committed(spark, path).collect()) == list(range(20))
    assert sorted(r.id for r in st.read_committed(spark, path, up_to=0).collect()) == list(range(10))
    with pytest.raises(RuntimeError):
        st.commit(spark, path, 1, {})


def test_another_engine_reads_the_manifest(spark, tmp_path):
    path = str(tmp_path / "t")
    write = st.committed_writer(path)
    for k in range(3):
        write(spark.range(k * 10, k * 10 + 10), k)
    files = []
    for k in range(3):
        with open(f"{path}/_commits/{k}.json") as f:
            entry = json.load(f)
        assert entry["rows"] == 10 and entry["batch_id"] == k
        files += [f"{path}/{x['file']}" for x in entry["files"]]
    assert duckdb.sql(f"SELECT count(*), sum(id) FROM read_parquet({files!r})").fetchall() == [(30, 435)]


def test_no_commit_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        st.read_committed(spark, str(tmp_path / "none"))


def test_snapshot_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "s")
    left = [2]
    write = st.snapshot_writer(path, ["d", "x"], F.col("d") % 4, lambda n: st.interrupt(left, n))
    schema = "d int, x string, n long"
    want = {}
    for b, rows in enumerate([[(0, "a", 1), (1, "a", 1), (1, None, 1), (2, "b", 1)], [(1, "a", 2), (1, None, 5)], [(1, "c", 3), (5, "a", 9)], [], [(3, "z", 1)]]):
        df = spark.createDataFrame(rows, schema)
        want.update({(d, x): n for d, x, n in rows})
        before = {b: st.read_manifest(spark, path, st.committed(spark, path)[-1])["buckets"] for _ in [0] if st.committed(spark, path)}
        if b == 2:
            seen = _rows(st.read_snapshot(spark, path, df.schema))
            with pytest.raises(st.Interrupted):
                write(df, b)
            assert _rows(st.read_snapshot(spark, path, df.schema)) == seen
        write(df, b)
        write(df, b)
        entry = st.read_manifest(spark, path, b)
        assert sorted(map(int, entry["rewritten"])) == sorted({d % 4 for d, _, _ in rows})
        for old in before.values():
            assert all(entry["buckets"][k] == f for k, f in old.items() if k not in entry["rewritten"])
        assert _rows(st.read_snapshot(spark, path, df.schema)) == sorted([(*k, n) for k, n in want.items()], key=repr)
    spent = st.rewritten_bytes(spark, path)
    assert spent[3] == 0 and all(spent[b] > 0 for b in (0, 1, 2, 4))
    assert st.vacuum_snapshot(spark, path)
    assert _rows(st.read_snapshot(spark, path, df.schema)) == sorted([(*k, n) for k, n in want.items()], key=repr)


def test_crash_after_the_write_then_restart(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [(k, dt.datetime(2026, 8, 1, 8) + dt.timedelta(minutes=k)) for k in range(30)]
    st.write_replay_log(spark.createDataFrame(rows, "id long, at timestamp"), log, ["at"], 5)
    write = st.crash_once(st.batch_writer(str(tmp_path / "out")), 3)
    go = lambda: st.run_until_done(st.start_foreach(st.read_replay(spark, log), write, str(tmp_path / "c"), "append", NOW))
    with pytest.raises(Exception, match="Interrupted"):
        go()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
    go()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(30))
