"""Session helpers.

The library never creates a session inside an operator; callers pass one in.
``local_session`` is the configuration used by tests, ``bench.py`` and the
driver entry point. ``shared_dir`` resolves the folder that queries use for
their intermediate tables and stream checkpoints.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session we build carries. AQE re-plans joins and coalesces
# shuffle partitions at run time; skew-join splitting covers hot keys in
# shuffle joins; the UTC zone keeps hour/weekday independent of the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for long-running streams with large state: RocksDB
# keeps state off the JVM heap, changelog checkpointing uploads only deltas.
# The shuffle partition count of a stateful stream is frozen in its
# checkpoint at first start, so size it for the cluster before starting.
STREAMING_SCALE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Starting points for a large cluster (about 1000 executors, 100 TB input):
# 256 MB scan splits; plenty of shuffle partitions that AQE coalesces to the
# advisory size; skewed shuffle partitions split above 256 MB / 5x median.
# ``spark.checkpoint.dir`` must name a shared file system folder.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Coalesce to the advisory size, not to keep every core busy.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tradewind", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TRADEWIND_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # Spark Connect has no SparkContext
        pass
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        return None


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:
        return spark.conf.get("spark.master", "").startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the deployer sets it to a shared file system; we only read
    it. Only a local-mode session (tests, bench) without one gets a fresh
    scratch folder of its own.
    """
    d = _conf_checkpoint_dir(spark)
    if d:
        return d
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) visible to every executor")
    d = tempfile.mkdtemp(prefix="tradewind-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    except Exception:  # no SparkContext in this client (e.g. Spark Connect)
        pass
    try:
        spark.conf.set("spark.checkpoint.dir", d)
    except Exception:  # some deployments refuse to change it at run time
        pass
    return d


class session_conf:
    """``with session_conf(spark, {key: value}):`` sets SQL confs for the
    block and restores them after. Used around ``writeStream.start()``,
    which snapshots the session (e.g. the state partition count)."""

    def __init__(self, spark: SparkSession, conf: dict[str, str]):
        self.spark, self.conf, self.saved = spark, conf, {}

    def __enter__(self):
        for k, v in self.conf.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self.spark

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


class persisted:
    """``with persisted(df) as d:`` caches a frame that is used more than
    once and unpersists it on exit."""

    def __init__(self, df, storage_level=None):
        self.df, self.level = df, storage_level

    def __enter__(self):
        return self.df.persist(self.level) if self.level is not None else self.df.persist()

    def __exit__(self, *exc):
        self.df.unpersist()
        return False


_scratch: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder, removed when
    the driver's Python ends (results may be read from it until then)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch.append((spark, path))
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark knows; a missing one is fine."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _remove_scratch() -> None:
    for spark, path in _scratch:
        # A stopped session leaves its folders to the deployer's own expiry.
        if getattr(spark.sparkContext, "_jsc", None) is not None:
            remove_path(spark, path)
    _scratch.clear()
