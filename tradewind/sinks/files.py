"""Batch sinks (K1, K2, K3 batch form, K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text form of timestamps in CSV files: microsecond precision, so a
# write/read round trip keeps every digit.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """K1: Parquet write. With ``partition_by`` and overwrite mode the
    session should use dynamic partition overwrite (see ``write_partitioned``)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_and_verify(df: DataFrame, path: str, mode: str = "overwrite") -> tuple[int, DataFrame]:
    """K2: write, count the written rows in the same job (an ``Observation``,
    not a second job over the input), read back, count what is read (from the
    file footers), and return (rows written, read-back frame). Raises if the
    counts differ. ``append`` counts what was there before the write too, so
    only the other modes are compared."""
    obs = Observation("written")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    written = obs.get["rows"]
    back = df.sparkSession.read.parquet(path)
    if mode != "append" and (stored := back.count()) != written:
        raise RuntimeError(f"{path}: {written} rows were written, {stored} are read back")
    return written, back


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str],
                      mode: str = "append", rebalance: bool = True) -> None:
    """K3 (batch form): append or dynamic-overwrite a Hive-style partitioned
    Parquet directory. A null partition value lands in
    ``__HIVE_DEFAULT_PARTITION__`` and reads back as null.

    ``rebalance`` shuffles rows by the partition columns through Spark's
    REBALANCE hint: each task then writes few directories (without it every
    task writes a file into every directory -- millions of small files at
    scale), and AQE splits an oversized directory (one tier can hold most
    rows) into several tasks and merges tiny ones. The price is one shuffle
    of the written rows; with ``rebalance=False`` there is no shuffle and
    each task writes at most one file per directory it holds rows for
    (Spark sorts by the partition columns inside the task first).
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a partitioned directory; partition columns come last and their
    types are inferred unless ``schema`` is given."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """K6: header + rows; null -> empty field."""
    (df.write.mode(mode).option("header", header)
       .option("timestampFormat", CSV_TIMESTAMP_FORMAT)
       .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
       .csv(path))
