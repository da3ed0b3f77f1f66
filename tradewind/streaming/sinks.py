"""Stream sinks, triggers and changelog readers.

Replay safety. A micro-batch can run twice: after a failure Spark replays
every batch whose commit marker is missing. Two sinks here survive that:

* ``start_file_sink`` -- Spark's native file sink. Its ``_spark_metadata``
  log names the files of committed batches, and Spark readers trust only
  those, so a replayed batch is never counted twice.
* ``batch_writer`` for ``foreachBatch`` -- every batch lands in its own
  ``batch_id=<n>`` folder, which a replay replaces as a whole, also if the code
  has changed in between. Any engine can read it. ``compact_batches`` folds
  finished batches into one partitioned table.

Checkpoints always live outside the data directory, under the caller's
shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import session_conf

BATCH_COL = "batch_id"

#: Stored bytes that one task of ``compact_batches`` folds into a file, and the
#: directories up to which it reads each by itself.
COMPACT_BYTES, MOST_DIRECTORIES = 128 << 20, 200


def trigger_options(processing_time: str | None = None, available_now: bool = False) -> dict:
    """Keyword arguments for ``DataStreamWriter.trigger``."""
    if available_now:
        return {"availableNow": True}
    if processing_time:
        return {"processingTime": processing_time}
    return {}


def batch_writer(path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                 on_batch: Callable[[int, int], None] | None = None):
    """A ``foreachBatch`` function writing each micro-batch to
    ``path/batch_id=<n>/<partition_by...>``, replacing that whole folder.

    The row count comes from an ``Observation`` on the write itself (D3),
    not from a second job over the batch. With ``partition_by`` the batch is
    rebalanced on those columns first (AQE runs inside ``foreachBatch``, so
    a dominant tier is split across tasks and each task writes few files).
    """
    def write(df: DataFrame, batch_id: int) -> None:
        obs = Observation(f"batch_{batch_id}")
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        out = df.observe(obs, F.count(F.lit(1)).alias("rows")).write
        if fmt == "parquet":
            out = out.option("compression", "zstd")
        (out.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy(*partition_by).save(f"{path}/{BATCH_COL}={batch_id}"))
        if on_batch is not None:
            on_batch(batch_id, obs.get["rows"])
    return write


def compact_batches(spark: SparkSession, path: str, into: str, partition_by: Sequence[str] = (),
                    up_to: int | None = None) -> DataFrame:
    """Fold the batches of ``path`` (those up to batch ``up_to``, which must be
    committed) into one table at ``into``, few files a partition; a rerun
    replaces it. The batch folders stay; the caller drops them once readers
    have moved on.

    The batches are laid out by ``partition_by`` already: the files of one
    directory go to one task for each ``COMPACT_BYTES`` and nothing is shuffled.
    Over ``MOST_DIRECTORIES``, too many for a plan each, rows are rebalanced."""
    rows = spark.read.parquet(path)
    if up_to is not None:
        rows = rows.where(F.col(BATCH_COL) <= up_to)
    directories = rows.groupBy(*partition_by).count().limit(MOST_DIRECTORIES + 1).collect() if partition_by else []
    rows = rows.drop(BATCH_COL)
    if len(directories) > MOST_DIRECTORIES:
        rows = rows.hint("rebalance", *partition_by)
    elif directories:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        stored = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
        total = sum(d["count"] for d in directories)
        rows = reduce(DataFrame.union, [
            rows.where(reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(d[c])) for c in partition_by]))
                .coalesce(-(-stored * d["count"] // (total * COMPACT_BYTES))) for d in directories])
    # A task writes few directories, so none is sorted first; one-task parts stay apart.
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4", "spark.sql.unionOutputPartitioning": "false"}):
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(into)
    return spark.read.parquet(into)


def _start(writer, df: DataFrame, state_partitions: int | None) -> StreamingQuery:
    """Start a stream. ``state_partitions`` fixes the number of state-store
    partitions of a stateful query; Spark records it in the checkpoint at
    the first start, so it cannot change later."""
    if not state_partitions:
        return writer.start()
    with session_conf(df.sparkSession, {"spark.sql.shuffle.partitions": str(state_partitions)}):
        return writer.start()


def start_foreach(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str = "append",
                  trigger: dict | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Run a streaming frame into any ``foreachBatch`` function."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger:
        w = w.trigger(**trigger)
    return _start(w, df, state_partitions)


def start_batch_sink(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                     partition_by: Sequence[str] = (), trigger: dict | None = None,
                     on_batch: Callable[[int, int], None] | None = None,
                     query_name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Run a streaming frame into ``batch_writer`` (any output mode)."""
    w = (df.writeStream.outputMode(output_mode)
           .option("checkpointLocation", checkpoint)
           .foreachBatch(batch_writer(path, partition_by, on_batch=on_batch)))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return _start(w, df, state_partitions)


def start_file_sink(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                    fmt: str = "parquet", trigger: dict | None = None,
                    state_partitions: int | None = None, files_per_partition: int | None = None) -> StreamingQuery:
    """K3 with Spark's exactly-once file sink (append mode only).

    Rows are first rebalanced on the partition columns (AQE runs in stateless
    streams): a directory gets files of the advisory size from as many tasks as
    its rows need, few of them however many tasks read the batch. With
    ``files_per_partition`` they are dealt by the partition columns and a salt
    below it instead, and a batch writes at most that many files into a
    directory; give it for stateful streams, which AQE does not split.
    The sink's metadata log lists every file
    and is compacted on the driver: bound the files with long triggers."""
    if partition_by and files_per_partition is None:
        df = df.hint("rebalance", *partition_by)
    elif partition_by:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], salt)
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger:
        w = w.trigger(**trigger)
    return _start(w, df, state_partitions)


def start_console_sink(df: DataFrame, output_mode: str = "update", truncate: bool = False,
                       trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """K4: print each batch (for interactive use; tests use the other sinks)."""
    w = df.writeStream.format("console").outputMode(output_mode).option("truncate", truncate)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def run_until_done(query: StreamingQuery) -> StreamingQuery:
    """Block until the query ends (an ``availableNow`` query ends by
    itself); re-raise its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def last_wins(changelog: DataFrame, keys: Sequence[str], batch_col: str = BATCH_COL) -> DataFrame:
    """T4 read side: an update-mode sink is a changelog, one row per changed
    key per batch. Keep each key's row from its latest batch.

    A key occurs at most once per batch, so no group is larger than the
    number of batches -- hot keys cannot skew this aggregate.
    """
    values = [c for c in changelog.columns if c not in keys and c != batch_col]
    latest = changelog.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.col(batch_col)).alias("__v"))
    return latest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])


def latest_batch(output: DataFrame, batch_col: str = BATCH_COL) -> DataFrame:
    """Complete-mode read side: each batch holds the whole result; keep the
    last one (the max batch id is a scalar subquery, not a driver round trip)."""
    newest = output.agg(F.max(batch_col)).scalar()
    return output.filter(F.col(batch_col) == newest).drop(batch_col)
