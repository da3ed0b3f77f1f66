"""Aggregations, sorts and top-k.

Every aggregate is a hash aggregate with a partial (map-side) stage, so a
hot group -- one exchange holding a third of all trades -- is combined
inside each task before anything is shuffled; the shuffle carries one row
per (task, group). Money totals are sums of raw doubles (``money_sum``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import WHALE_ABOVE, money_avg, money_sum


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """A1 as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def exchange_stats(clean: DataFrame, group_col: str = "exchange",
                   amount_col: str = "amount_usd") -> DataFrame:
    """A2 + O1: per exchange count, total, mean and max amount, largest total
    first (ties by exchange so the order is total)."""
    return (clean.groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("trade_count"),
                 money_sum(amount_col).alias("total_volume"),
                 money_avg(amount_col).alias("avg_trade_size"),
                 F.max(amount_col).alias("max_trade_size"))
            .orderBy(F.col("total_volume").desc_nulls_last(), F.col(group_col).asc_nulls_last()))


def top_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """First row in ``order`` -- planned as a top-1 (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(1)


def top_exchange(stats: DataFrame, group_col: str = "exchange") -> DataFrame:
    """O4 over A2: the exchange with the largest total volume."""
    return top_row(stats, [F.col("total_volume").desc_nulls_last(),
                           F.col(group_col).asc_nulls_last()]).select(group_col)


def group_count(df: DataFrame, group_col: str) -> DataFrame:
    """A3: ``groupBy(col).count()``; a null key is its own group."""
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias("count"))


def share_of_total(df: DataFrame, group_col: str) -> DataFrame:
    """A4: per group count and percent of all rows.

    The grand total is a scalar subquery over the grouped counts: no driver
    loop, no cross join and no single-partition window, whatever the number
    of groups. Percent is unrounded; round for display.
    """
    counts = group_count(df, group_col)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", F.col("count").cast("double") * 100.0 / total)


def tier_stats(enriched: DataFrame, tier_col: str = "amount_category",
               amount_col: str = "amount_received") -> DataFrame:
    """A5: per amount tier count, mean and total amount."""
    return (enriched.groupBy(tier_col)
            .agg(F.count(F.lit(1)).alias("count"),
                 money_avg(amount_col).alias("avg_amount"),
                 money_sum(amount_col).alias("total_amount")))


def weekday_stats(enriched: DataFrame, day_col: str = "day_of_week",
                  amount_col: str = "amount_received") -> DataFrame:
    """Per weekday count and total amount, by weekday (nulls first)."""
    return (enriched.groupBy(day_col)
            .agg(F.count(F.lit(1)).alias("count"), money_sum(amount_col).alias("total_amount"))
            .orderBy(F.col(day_col).asc_nulls_first()))


def hour_stats(enriched: DataFrame, hour_col: str = "hour_of_day") -> DataFrame:
    """Per hour count, by hour, the group of unparsable times (null)
    first: up to 25 rows."""
    return (enriched.groupBy(hour_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col(hour_col).asc_nulls_first()))


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """A8 as the reference prints it: ``summary`` + string values."""
    return df.select(column).describe()


def amount_summary(df: DataFrame, column: str) -> DataFrame:
    """A8, typed: count, mean, sample stddev, min, max in one aggregate."""
    c = F.col(column)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"),
                  F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max"))


def trade_summary(trades: DataFrame, group_col: str = "exchange", amount_col: str = "amount_usd",
                  above: float = WHALE_ABOVE) -> DataFrame:
    """Total trades, cleaned trades, whale trades (over raw rows) and the
    top exchange by cleaned volume -- one scan.

    Stage 1 groups raw rows by exchange (partial aggregation in every task);
    stage 2 folds the handful of exchange rows into one.
    """
    amt = F.col(amount_col)
    clean = amt.isNotNull() & ~F.isnan(amt) & F.col(group_col).isNotNull()
    per_group = trades.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(clean).alias("clean_rows"),
        F.count_if(amt > F.lit(above)).alias("whale_rows"),
        money_sum(F.when(clean, amt)).alias("clean_volume"),
    )
    rank = F.when(F.col("clean_rows") > 0,
                  F.struct((-F.col("clean_volume")).alias("v"), F.col(group_col).alias("k")))
    return per_group.agg(
        F.sum("rows").alias("total_trades"),
        F.sum("clean_rows").alias("cleaned_trades"),
        F.sum("whale_rows").alias("whale_trades"),
        F.min_by(F.col(group_col), rank).alias("top_exchange"))


def frequency_profile(df: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    """A10: value counts, most frequent first (ties by value), nulls excluded;
    ``top_n`` keeps the first n (a top-k report), ``None`` keeps all."""
    counts = (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("count")))
    ordered = counts.orderBy(F.col("count").desc(), F.col(column).asc())
    return ordered.limit(top_n) if top_n else ordered


def label_rate(df: DataFrame, column: str = "is_laundering_flag", name: str = "label_rate") -> DataFrame:
    """Mean of a 0/1 label, nulls excluded."""
    return df.agg(F.avg(F.col(column).cast("double")).alias(name))


def flag_tally(df: DataFrame, column: str = "is_laundering_flag") -> DataFrame:
    """Rows sent, flagged rows and the flagged percent (null if nothing
    was sent rather than a division error)."""
    return (df.agg(F.count(F.lit(1)).alias("sent"),
                   F.count_if(F.col(column) == F.lit(1)).alias("flagged"))
            .withColumn("flagged_pct",
                        F.col("flagged").cast("double") * 100.0 / F.nullif(F.col("sent"), F.lit(0))))
