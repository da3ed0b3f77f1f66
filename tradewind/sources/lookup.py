"""S3: small in-memory lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import TRADER_SCHEMA

# The reference's five-trader lookup, in its order.
DEFAULT_TRADERS = [
    ("TRADER0001", "Alice Johnson", "LOW"),
    ("TRADER0005", "Bob Smith", "MEDIUM"),
    ("TRADER0010", "Charlie Brown", "HIGH"),
    ("TRADER0020", "Diana Prince", "LOW"),
    ("TRADER0050", "Eve Wilson", "HIGH"),
]


def inline_lookup(spark: SparkSession, rows: Sequence[tuple],
                  schema: T.StructType | Sequence[str]) -> DataFrame:
    """A driver-side list as a DataFrame. Only for small, fixed-size tables;
    anything that grows with the data belongs in a file."""
    return spark.createDataFrame(list(rows), schema)


def trader_lookup(spark: SparkSession, rows: Sequence[tuple] = DEFAULT_TRADERS) -> DataFrame:
    return inline_lookup(spark, rows, TRADER_SCHEMA)
