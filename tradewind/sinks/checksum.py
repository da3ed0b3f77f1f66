"""Contents of a table as an order-free checksum (K2).

The checksum of a multiset of rows is the number of rows, the sum of their
64-bit hashes and the exclusive or of other ones. All three merge in any order,
so they are taken inside the write and again inside a scan, whatever the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Checksum:
    rows: int
    total: int
    mixed: int


def _measures(df: DataFrame):
    # A null leaves a hash as it is, so whether a value is null is hashed too.
    cols = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    first, second = F.xxhash64(*cols), F.xxhash64(F.lit("mixed"), *cols)
    return [F.count(F.lit(1)).alias("rows"), F.sum(first.cast("decimal(38,0)")).alias("total"), F.bit_xor(second).alias("mixed")]


def _of(values: dict) -> Checksum:
    return Checksum(int(values["rows"]), int(values["total"] or 0), int(values["mixed"] or 0))


def checksum(df: DataFrame) -> Checksum:
    """Checksum of a frame, in one aggregate. Columns of map type have no hash."""
    return _of(df.agg(*_measures(df)).first().asDict())


def write_with_checksum(df: DataFrame, path: str, mode: str = "overwrite") -> Checksum:
    """Write Parquet; the checksum of the written rows rides along as an
    ``Observation``, so the input is computed once."""
    obs = Observation("contents")
    df.observe(obs, *_measures(df)).write.mode(mode).parquet(path)
    return _of(obs.get)


def verify_contents(spark: SparkSession, path: str, schema, expected: Checksum) -> DataFrame:
    """The stored table, if it holds exactly the rows of ``expected``; an error
    names what differs. One scan."""
    back = spark.read.schema(schema).parquet(path)
    found = checksum(back)
    if found != expected:
        raise RuntimeError(f"{path}: {expected} was written, {found} is read back")
    return back
