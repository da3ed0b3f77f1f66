"""Batch commits that readers can trust: a manifest file a batch.

``path/data`` holds what attempts wrote, ``path/_commits/<n>.json`` what batch n
committed. A manifest is written under another name and renamed, so it is there
whole or not at all; data that no manifest names is invisible. A batch that runs
again after its commit does nothing, one that runs again before it writes a new
attempt. Spark allows one writer a checkpoint, so batches commit in order. The
manifests are plain JSON with relative file names, which any engine can read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path

COMMITS, DATA = "_commits", "data"
BUCKET = "_bucket"


class Interrupted(RuntimeError):
    """A crash on purpose."""


def crash_once(write: Callable[[DataFrame, int], None], batch: int) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that fails once, when ``batch`` has been
    written and Spark has not yet recorded it as done."""
    left = [batch]

    def run(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id)
        interrupt(left, batch_id)
    return run


def interrupt(left: list[int], batch_id: int) -> None:
    """Raise if ``batch_id`` is in ``left``, and take it out."""
    if batch_id in left:
        left.remove(batch_id)
        raise Interrupted(f"batch {batch_id}")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed batches, ascending."""
    return sorted(int(n[:-5]) for n in _names(spark, f"{path}/{COMMITS}") if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, path: str, batch_id: int) -> dict:
    text = spark.read.text(f"{path}/{COMMITS}/{batch_id}.json", wholetext=True).first()[0]
    return json.loads(text)


def commit(spark: SparkSession, path: str, batch_id: int, entry: dict) -> None:
    """Make ``entry`` the manifest of the batch, at once."""
    fs, final = _fs(spark, f"{path}/{COMMITS}/{batch_id}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/_{batch_id}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"batch_id": batch_id, **entry}).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"batch {batch_id} of {path} is committed already")


def _files(spark: SparkSession, path: str, folder: str) -> list[dict]:
    """Data files below ``path/folder``: name relative to ``path``, and bytes."""
    fs, p = _fs(spark, f"{path}/{folder}")
    base = fs.makeQualified(_fs(spark, path)[1]).toUri().getPath().rstrip("/") + "/"
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        s = found.next()
        if s.getPath().getName().startswith("part-"):
            out.append({"file": s.getPath().toUri().getPath().removeprefix(base), "bytes": s.getLen()})
    return out


def committed_writer(path: str, partition_by: Sequence[str] = (),
                     before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends each batch to the table
    at ``path``. The row count is an ``Observation`` on the write. With
    ``partition_by`` rows are rebalanced on those columns first. The files a
    manifest lists are one batch's."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if batch_id in committed(spark, path):
            return
        obs = Observation(f"commit_{batch_id}")
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        folder = f"{DATA}/batch={batch_id}/attempt={uuid.uuid4().hex}"
        rows.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").partitionBy(*partition_by).parquet(f"{path}/{folder}")
        if before_commit is not None:
            before_commit(batch_id)
        commit(spark, path, batch_id, {"rows": obs.get["rows"], "folder": folder, "files": _files(spark, path, folder)})
    return write


def read_committed(spark: SparkSession, path: str, up_to: int | None = None) -> DataFrame:
    """The rows of all committed batches (those up to ``up_to``). The driver
    learns one folder a batch, Spark lists the files."""
    done = [n for n in committed(spark, path) if up_to is None or n <= up_to]
    if not done:
        raise ValueError(f"{path}: no committed batch")
    entries = spark.read.json([f"{path}/{COMMITS}/{n}.json" for n in done]).select("folder", "rows").collect()
    folders = [f"{path}/{r['folder']}" for r in entries if r["rows"]] or [f"{path}/{entries[0]['folder']}"]
    return spark.read.option("basePath", f"{path}/{DATA}").parquet(*folders).drop("batch", "attempt")


def snapshot_writer(path: str, keys: Sequence[str], bucket: Column,
                    before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """T4: a ``foreachBatch`` function that folds an update-mode changelog into
    a table with one row a key. ``bucket`` (an integer column over the rows)
    deals keys to buckets; a batch reads and rewrites only the buckets that its
    keys fall into, and its manifest names the current folder of every bucket.
    Take the number of buckets so that one is a task's worth of rows, and a
    column under which recent keys share buckets. Keys may be null."""
    def merge(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        done = committed(spark, path)
        if done and batch_id <= done[-1]:
            return
        current = read_manifest(spark, path, done[-1])["buckets"] if done else {}
        # The batch is read twice and its state must not be computed twice.
        changed = df.withColumn(BUCKET, bucket.cast("int")).persist()
        try:
            touched = [str(r[0]) for r in changed.select(BUCKET).distinct().collect()]  # at most the buckets
            rows = changed
            old = [f"{path}/{current[b]}" for b in touched if b in current]
            if old:
                stored = spark.read.schema(df.schema).parquet(*old).withColumn(BUCKET, bucket.cast("int"))
                new = changed.select(*[F.col(k).alias(f"_new_{i}") for i, k in enumerate(keys)])
                same = [F.col(k).eqNullSafe(F.col(f"_new_{i}")) for i, k in enumerate(keys)]
                rows = stored.join(new, same, "left_anti").unionByName(changed)
            folder = f"{DATA}/version={batch_id}-{uuid.uuid4().hex}"
            if touched:
                rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
        finally:
            changed.unpersist()
        if before_commit is not None:
            before_commit(batch_id)
        written = sum(f["bytes"] for f in _files(spark, path, folder)) if touched else 0
        commit(spark, path, batch_id, {"buckets": {**current, **{b: f"{folder}/{BUCKET}={b}" for b in touched}},
                                       "rewritten": touched, "bytes": written})
    return merge


def read_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table as of the last commit: one folder a bucket."""
    done = committed(spark, path)
    buckets = read_manifest(spark, path, done[-1])["buckets"] if done else {}
    if not buckets:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in buckets.values()])


def rewritten_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes that each committed batch of a snapshot wrote."""
    return {n: read_manifest(spark, path, n)["bytes"] for n in committed(spark, path)}


def vacuum_snapshot(spark: SparkSession, path: str) -> list[str]:
    """Drop the bucket folders that the last commit does not name, once no
    reader uses them; returns them."""
    done = committed(spark, path)
    live = set(read_manifest(spark, path, done[-1])["buckets"].values()) if done else set()
    stale = [f"{DATA}/{v}/{b}" for v in _names(spark, f"{path}/{DATA}") for b in _names(spark, f"{path}/{DATA}/{v}")
             if b.startswith(BUCKET) and f"{DATA}/{v}/{b}" not in live]
    for folder in stale:
        remove_path(spark, f"{path}/{folder}")
    return stale
