"""File and range sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True, **options) -> DataFrame:
    """CSV with a declared schema (no inference pass); empty field -> null.

    Ids that look numeric (``0012345``, ``1E5``) stay strings because the
    schema says so.
    """
    reader = spark.read.schema(schema).option("header", header)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def raw_columns(header: list[str]) -> dict[str, str]:
    """Canonical name -> column of a raw transaction header, by name. The
    second ``Account`` may be called ``Account.1`` or, where a header repeats
    ``Account`` and Spark numbers the repeats, is the later one. Raises on a
    missing name."""
    from ..schemas import TRANSACTION_RAW_NAMES, TRANSACTION_SCHEMA
    repeats = [c for c in header if re.fullmatch(r"Account\d+", c)]
    found = {}
    for raw, name in TRANSACTION_RAW_NAMES.items():
        if name not in TRANSACTION_SCHEMA.fieldNames():
            continue
        if raw in header:
            found[name] = raw
        elif raw.startswith("Account") and len(repeats) == 2:
            found[name] = repeats[raw == "Account.1"]
        else:
            raise ValueError(f"the transaction file has no column {raw!r}; its header is {header}")
    return found


def read_raw_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """S1 for the raw transaction feed (headers ``Timestamp``, ``From Bank``,
    ``Account``, ``Account.1``, ...): columns are found by header name, in
    whatever order the file has them, and take the declared types (text that
    does not parse gives null). All files of a folder share one header."""
    from ..schemas import TRANSACTION_RAW_NAMES, TRANSACTION_SCHEMA
    reader = spark.read.option("header", True).option("inferSchema", False)
    raw = reader.csv(path)
    column = raw_columns(raw.columns)
    if set(column.values()) <= set(TRANSACTION_RAW_NAMES):  # no numbered repeats: each file's header can be checked
        raw = reader.option("enforceSchema", False).csv(path)
    return raw.select(*[F.col(f"`{column[f.name]}`").try_cast(f.dataType).alias(f.name) for f in TRANSACTION_SCHEMA.fields])


def infer_csv_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Opt-in schema inference: one extra pass over the file(s)."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("samplingRatio", sampling_ratio).csv(path).schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan of a file or a (partitioned) directory."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_range(spark: SparkSession, n: int, start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """``id`` from ``start`` to ``start + n - 1`` as a bigint column."""
    return spark.range(start, start + n, 1, num_partitions)


def schema_report(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and SQL type names (the data in ``printSchema``)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
