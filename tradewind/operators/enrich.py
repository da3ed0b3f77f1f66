"""Transaction enrichment (X1, X2, X4, X6, X7, X8; T10).

One function for batch and stream: it is a single stateless projection, so
it never shuffles and fuses into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (amount_tier, day_of_week, hour_of_day, laundering_flag,
                                 parse_pattern_time, TRANSACTION_TIME_FORMAT)


def enrich_transactions(df: DataFrame, amount_col: str = "amount_received",
                        flag_col: str = "is_laundering_flag", time_col: str = "ts",
                        time_format: str = TRANSACTION_TIME_FORMAT) -> DataFrame:
    """Add amount_category, event_timestamp, hour_of_day, day_of_week, is_laundering."""
    event_ts = parse_pattern_time(time_col, time_format)
    return (df.withColumns({
                "amount_category": amount_tier(amount_col),
                "event_timestamp": event_ts,
            })
            .withColumns({
                "hour_of_day": hour_of_day("event_timestamp"),
                "day_of_week": day_of_week("event_timestamp"),
                "is_laundering": laundering_flag(flag_col),
            }))


def with_processing_time(df: DataFrame, name: str = "processing_time") -> DataFrame:
    """Processing time, constant within a query or micro-batch."""
    return df.withColumn(name, F.current_timestamp())
