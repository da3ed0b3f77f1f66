"""Keyed state: redelivered messages, sessions, a lookup that changes over time.

All three keep state per key and drop it by the watermark, so state is bounded
by what happens within the watermark (and the session gap, or the longest
validity), not by the length of the stream. Each function takes batch frames too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import money_sum
from .windows import TRADE_WATERMARK

# Sessions of one key in one task are merged before they are shuffled: a hot
# key sends its sessions, not its rows.
SESSION_CONF = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def distinct_messages(df: DataFrame, keys: Sequence[str], time_col: str = "event_timestamp",
                      within: str = TRADE_WATERMARK) -> DataFrame:
    """Rows whose ``keys`` have not been seen: of a message delivered again only
    the first copy stays. A key is remembered for ``within`` after its event
    time; a copy that comes later than that is dropped as late. Rows without an
    event time cannot expire and are dropped, as a window drops them."""
    rows = df.where(F.col(time_col).isNotNull())
    if not df.isStreaming:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark(time_col, within).dropDuplicatesWithinWatermark(list(keys))


def trader_sessions(df: DataFrame, gap: str, key_col: str = "trader_id", time_col: str = "event_timestamp",
                    amount_col: str = "amount_usd", watermark: str | None = TRADE_WATERMARK) -> DataFrame:
    """Per key, stretches of rows at most ``gap`` apart: start, end (last row
    plus ``gap``), rows and amount. As a stream in append mode, a session comes
    out once the watermark has passed its end."""
    rows = df.where(F.col(time_col).isNotNull())
    if df.isStreaming and watermark:
        rows = rows.withWatermark(time_col, watermark)
    found = rows.groupBy(F.session_window(time_col, gap).alias("session"), F.col(key_col)).agg(
        F.count(F.lit(1)).alias("trade_count"), money_sum(amount_col).alias("total_volume"))
    return found.select(key_col, F.col("session.start").cast("timestamp_ntz").alias("session_start"),
                        F.col("session.end").cast("timestamp_ntz").alias("session_end"), "trade_count", "total_volume")


def validity(versions: DataFrame, key_col: str, from_col: str, longest: str, to_col: str = "valid_to") -> DataFrame:
    """Until when each version of a key holds: the next one's start, ``longest``
    after its own at most. A key's versions meet in one task: its own history,
    not its trades."""
    following = F.lead(from_col).over(W.partitionBy(key_col).orderBy(from_col))
    latest = F.col(from_col) + F.expr(f"INTERVAL {longest}")
    return versions.withColumn(to_col, F.least(F.coalesce(following, latest), latest))


def versioned_join(trades: DataFrame, versions: DataFrame, key_col: str, time_col: str, from_col: str, to_col: str,
                   longest: str, watermark: str = TRADE_WATERMARK) -> DataFrame:
    """J1 against a lookup that changes: each trade with the version of its key
    that held at its time. Both sides may be streams; then both keep state, a
    trade until no version that holds at its time can come any more, a version
    until ``longest`` after its start, which no validity exceeds. Both sides
    name the key alike; their other columns must differ."""
    right = versions.withColumnRenamed(key_col, "_key")
    if trades.isStreaming:
        trades = trades.withWatermark(time_col, watermark)
    if versions.isStreaming:
        right = right.withWatermark(from_col, watermark)
    t, since = F.col(time_col), F.col(from_col)
    holds = (F.col(key_col) == F.col("_key")) & (t >= since) & (t < F.col(to_col)) & (t < since + F.expr(f"INTERVAL {longest}"))
    return trades.join(right, holds).drop("_key")
