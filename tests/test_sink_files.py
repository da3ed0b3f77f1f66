"""Files that stream sinks write, replayed batches, compaction, the feed job."""
import glob
import json
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tradewind import operators as ops
from tradewind import sinks
from tradewind import streaming as st
from tradewind.plans import jobs, queries
from tradewind.session import session_conf
from tradewind.sources import views


def _files(path):
    return [f for f in glob.glob(f"{path}/**/part-*", recursive=True)]


def test_file_sink_bounds_files_per_directory(spark, tmp_path):
    """Many small source files, few output files in each directory."""
    table = str(tmp_path / "t" / "lineitem.parquet")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(24).write.parquet(table)
    stream = st.enriched_transaction_stream(queries._transaction_stream(spark, str(tmp_path / "t")))
    out = str(tmp_path / "out")
    q = st.run_until_done(st.start_file_sink(stream, out, str(tmp_path / "ck"), queries.ENRICH_PARTITIONS,
                                             trigger=queries.AVAILABLE_NOW, files_per_partition=2))
    per_dir = {}
    for f in _files(out):
        per_dir[os.path.dirname(f)] = per_dir.get(os.path.dirname(f), 0) + 1
    assert per_dir and max(per_dir.values()) <= 2
    assert spark.read.parquet(out).count() == spark.read.parquet(table).count()
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("from_json") == 1


def test_window_stream_plan_is_partial_and_stateful(spark, tmp_path):
    agg = st.trade_windows(queries._trade_stream(spark, SF_SMALL))
    q = st.run_until_done(st.start_batch_sink(agg, str(tmp_path / "o"), str(tmp_path / "c"), "update",
                                              trigger=queries.AVAILABLE_NOW, state_partitions=2))
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert "partial_count" in plan and "StateStoreSave" in plan and plan.count("from_json") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_replayed_batch_replaces_its_whole_folder(spark, tmp_path):
    """Also when the second run writes other partitions than the first."""
    out, write = str(tmp_path / "o"), st.batch_writer(str(tmp_path / "o"), ["k"])
    df = spark.range(10).withColumn("k", F.lit("a"))
    write(df, 0)
    write(df, 1)
    write(df.withColumn("k", F.lit("b")), 1)
    got = {(r.batch_id, r.k): r["count"] for r in spark.read.parquet(out).groupBy("batch_id", "k").count().collect()}
    assert got == {(0, "a"): 10, (1, "b"): 10}


def test_compaction_keeps_rows_and_shrinks_files(spark, tmp_path):
    out, into = str(tmp_path / "o"), str(tmp_path / "c")
    write = st.batch_writer(out, ["k"])
    for b in range(4):
        write(spark.range(30).withColumn("k", F.col("id") % 3), b)
    table = st.compact_batches(spark, out, into, ["k"], up_to=2)
    assert table.columns == ["id", "k"] and table.count() == 90
    assert len(_files(into)) < len(_files(out))
    assert st.compact_batches(spark, out, into, ["k"]).count() == 120  # a rerun replaces it


def test_file_sink_splits_a_large_directory(spark, tmp_path):
    """A directory that holds most rows is written by more tasks, by its size."""
    spark.range(0, 400_000, 1, 16).select("id", F.lit("a").alias("k")).write.parquet(str(tmp_path / "t.parquet"))
    rows = st.read_table_stream(spark, str(tmp_path), "t")
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}):
        st.run_until_done(st.start_file_sink(rows, str(tmp_path / "o"), str(tmp_path / "c"), ["k"], trigger=queries.AVAILABLE_NOW))
    assert len(_files(str(tmp_path / "o"))) > 4
    assert spark.read.parquet(str(tmp_path / "o")).agg(F.count("*"), F.sum("id")).first() == (400_000, sum(range(400_000)))


def test_compaction_does_not_shuffle(spark, tmp_path, monkeypatch):
    out, into = str(tmp_path / "o"), str(tmp_path / "c")
    for b in range(3):
        st.batch_writer(out, ["k", "l"])(spark.range(40).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"), F.lit("a=/b c").alias("l")), b)
    want = sorted(map(tuple, spark.read.parquet(out).select("id", "k", "l").collect()), key=repr)
    with monkeypatch.context() as m:
        m.delattr(type(spark.range(1)), "hint")
        table = st.compact_batches(spark, out, into, ["k", "l"])
    assert sorted(map(tuple, table.collect()), key=repr) == want and len(_files(into)) < len(_files(out))
    monkeypatch.setattr("tradewind.streaming.sinks.MOST_DIRECTORIES", 2)
    assert sorted(map(tuple, st.compact_batches(spark, out, into, ["k", "l"]).collect()), key=repr) == want


def test_feed_job_encodes_under_wire_names(spark, tmp_path):
    from tradewind.schemas import TRANSACTION_RAW_NAMES
    names = [k for k, v in TRANSACTION_RAW_NAMES.items() if v != "kafka_timestamp"]
    t = views.transactions(spark, SF_SMALL)
    csv = str(tmp_path / "csv")
    sinks.write_csv(t.toDF(*names), csv)
    rows = jobs.transaction_feed(spark, csv).collect()
    assert len(rows) == t.count()
    body = json.loads(rows[0].value)
    assert set(body) <= set(TRANSACTION_RAW_NAMES) and body["Timestamp"] and body["kafka_timestamp"]
    assert rows[0].key == str(body["From Bank"])
    assert jobs.transaction_feed(spark, csv, limit=5).count() == 5


def test_write_and_verify_raises_on_a_difference(spark, tmp_path, monkeypatch):
    import pytest
    df = ops.row_count(views.trades(spark, SF_SMALL))
    written, back = sinks.write_and_verify(df, str(tmp_path / "x"))
    assert written == 1 and back.count() == 1
    monkeypatch.setattr(type(df), "count", lambda self: 7)
    with pytest.raises(RuntimeError, match="1 rows were written, 7"):
        sinks.write_and_verify(df, str(tmp_path / "y"))
