"""Projections, filters and cleaning.

All narrow except ``quality_report``, which is one global aggregate with a
partial stage per task (no shuffle of rows, one row per task crosses the
network).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import WHALE_ABOVE, whale_flag

TRADE_CLEAN_SUBSET = ("amount_usd", "exchange")
WHALE_COLUMNS = ("trade_id", "exchange", "amount_usd")


def whale_trades(df: DataFrame, amount_col: str = "amount_usd", above: float = WHALE_ABOVE,
                 columns: Sequence[str] | None = WHALE_COLUMNS) -> DataFrame:
    """F1 + P1: rows with ``amount > above`` (strict, null excluded), projected.

    The comparison reaches the Parquet reader as a pushed filter.
    """
    out = df.filter(F.col(amount_col) > F.lit(above))
    return out.select(*columns) if columns else out


def require(df: DataFrame, column: str) -> DataFrame:
    """keep rows whose ``column`` is not null."""
    return df.filter(F.col(column).isNotNull())


def _is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN for floating columns -- what ``dropna`` treats as missing."""
    c = F.col(column)
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def drop_incomplete(df: DataFrame, subset: Sequence[str] = TRADE_CLEAN_SUBSET) -> DataFrame:
    """drop rows with a null (or NaN) in any column of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def clean_trades(df: DataFrame, subset: Sequence[str] = TRADE_CLEAN_SUBSET,
                 amount_col: str = "amount_usd", above: float = WHALE_ABOVE) -> DataFrame:
    """F4 + X3: drop incomplete trades and add ``is_whale_trade``."""
    return drop_incomplete(df, subset).withColumn("is_whale_trade", whale_flag(amount_col, above))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """one row, ``null_<column>`` = number of null rows, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def quality_report(df: DataFrame, subset: Sequence[str] = TRADE_CLEAN_SUBSET) -> DataFrame:
    """F5 (+F2): original, cleaned, removed rows and per-column null counts in
    a single aggregate over the raw frame (the reference runs six jobs)."""
    complete = None
    for c in subset:
        ok = ~_is_missing(df, c)
        complete = ok if complete is None else (complete & ok)
    counted = df.agg(
        F.count(F.lit(1)).alias("original_rows"),
        F.count_if(complete).alias("cleaned_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in subset],
    )
    return counted.select(
        "original_rows", "cleaned_rows",
        (F.col("original_rows") - F.col("cleaned_rows")).alias("removed_rows"),
        *[f"null_{c}" for c in subset])


def fill_nulls(df: DataFrame, value="", subset: Sequence[str] | None = None) -> DataFrame:
    """replace nulls with ``value`` in columns of a matching type
    (strings for ``""``), as the feeders did before encoding."""
    return df.na.fill(value, subset=list(subset) if subset else None)


def head(df: DataFrame, n: int | None, order_by: Sequence[str] | str) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order; ``None`` or 0 =
    all of them, unsorted.

    Spark plans ``orderBy + limit`` as a top-k (TakeOrderedAndProject): each
    task keeps n rows, no full sort of the input.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n) if n else df
