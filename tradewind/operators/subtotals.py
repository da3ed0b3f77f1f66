"""Subtotals over several sets of columns in one scan (grouping sets)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import money_sum


def subtotals(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], amount_col: str) -> DataFrame:
    """Rows and total amount for every set of ``dims`` in ``sets`` (an empty set
    is the grand total). ``grouping_id`` has a bit per column of ``dims``, the
    first one highest, that is 1 where the column is summed over: it tells a
    total from the group of nulls.

    Rows are first grouped by all ``dims``, and only these groups are expanded
    into the sets, so the scan and its partial aggregation run once and Expand
    multiplies groups, not rows."""
    unknown = {c for s in sets for c in s} - set(dims)
    if unknown:
        raise ValueError(f"not among the dimensions: {sorted(unknown)}")
    finest = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("_rows"), money_sum(amount_col).alias("_amount"))
    return finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(
        F.grouping_id().cast("long").alias("grouping_id"), F.sum("_rows").alias("count"), F.sum("_amount").alias("total_amount"))
