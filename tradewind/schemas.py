"""Declared schemas and canonical column names.

Every schema is declared; inference is an explicit opt-in scan
(``sources.files.infer_csv_schema``). Canonical names are snake_case.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The names of a trade message / CSV row. ``event_time`` stays a string in messages
# (ISO-8601) and is parsed by ``functions.parse_iso_time``.
TRADE_SCHEMA = T.StructType([
    T.StructField("trade_id", T.StringType(), True),
    T.StructField("exchange", T.StringType(), True),
    T.StructField("coin", T.StringType(), True),
    T.StructField("trader_id", T.StringType(), True),
    T.StructField("amount_usd", T.DoubleType(), True),
    T.StructField("event_time", T.StringType(), True),
])

# Transaction row with canonical names (the raw feed's headers are mapped by
# ``TRANSACTION_RAW_NAMES``).
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("ts", T.StringType(), True),
    T.StructField("from_bank", T.IntegerType(), True),
    T.StructField("from_account", T.StringType(), True),
    T.StructField("to_bank", T.IntegerType(), True),
    T.StructField("to_account", T.StringType(), True),
    T.StructField("amount_received", T.DoubleType(), True),
    T.StructField("receiving_currency", T.StringType(), True),
    T.StructField("amount_paid", T.DoubleType(), True),
    T.StructField("payment_currency", T.StringType(), True),
    T.StructField("payment_format", T.StringType(), True),
    T.StructField("is_laundering_flag", T.IntegerType(), True),
])

# Transaction message: the row plus the ingest stamp added by the encoder.
TRANSACTION_MESSAGE_SCHEMA = T.StructType(
    TRANSACTION_SCHEMA.fields + [T.StructField("kafka_timestamp", T.StringType(), True)])

# Header names of the raw transaction feed, in file order,
# mapped to our canonical names. "Account.1" is how a repeated "Account"
# header is named by the feed's writer.
TRANSACTION_RAW_NAMES = {
    "Timestamp": "ts",
    "From Bank": "from_bank",
    "Account": "from_account",
    "To Bank": "to_bank",
    "Account.1": "to_account",
    "Amount Received": "amount_received",
    "Receiving Currency": "receiving_currency",
    "Amount Paid": "amount_paid",
    "Payment Currency": "payment_currency",
    "Payment Format": "payment_format",
    "Is Laundering": "is_laundering_flag",
    "kafka_timestamp": "kafka_timestamp",
}

# A transaction message on the wire: the feed's own names, in order.
TRANSACTION_WIRE_SCHEMA = T.StructType([
    T.StructField(raw, TRANSACTION_MESSAGE_SCHEMA[name].dataType, True)
    for raw, name in TRANSACTION_RAW_NAMES.items()])

TRADER_SCHEMA = T.StructType([
    T.StructField("trader_id", T.StringType(), True),
    T.StructField("trader_name", T.StringType(), True),
    T.StructField("risk_level", T.StringType(), True),
])

# Kafka-shaped message frame.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# Columns the enrichment adds to a transaction frame.
ENRICHED_COLUMNS = ["amount_category", "event_timestamp", "hour_of_day",
                    "day_of_week", "is_laundering"]
