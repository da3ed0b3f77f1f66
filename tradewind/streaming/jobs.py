"""The reference's two stream jobs as plain frame transformations.

* trade stream: messages -> decode (trade_id required) -> ISO event time ->
  2-minute watermark -> 1-minute windows per exchange (count, volume);
* transaction stream: messages -> decode (ts required) -> processing time
  -> enrichment, the same ``enrich_transactions`` as the batch job (T10).

Both are stateless up to the windowed aggregate and accept any frame with
a ``value`` column: Kafka, a message log, or a batch frame for testing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..operators.enrich import enrich_transactions, with_processing_time
from ..schemas import TRADE_SCHEMA
from ..sources.decode import decode_messages, decode_transactions
from .windows import TRADE_WATERMARK, TRADE_WINDOW, windowed_trade_stats, with_event_time


def decoded_trades(messages: DataFrame, schema: T.StructType = TRADE_SCHEMA) -> DataFrame:
    """S6 + X5 for trades: rows with a trade id and a parsed event time."""
    return with_event_time(decode_messages(messages, schema, required="trade_id"), "event_time")


def trade_windows(messages: DataFrame, schema: T.StructType = TRADE_SCHEMA,
                  window: str = TRADE_WINDOW, watermark: str | None = TRADE_WATERMARK,
                  sort: bool = False) -> DataFrame:
    """T1-T3 over decoded trade messages."""
    return windowed_trade_stats(decoded_trades(messages, schema), window=window,
                                watermark=watermark, sort=sort)


def enriched_transaction_stream(messages: DataFrame) -> DataFrame:
    """Decode, stamp processing time, enrich."""
    return enrich_transactions(with_processing_time(decode_transactions(messages)))
