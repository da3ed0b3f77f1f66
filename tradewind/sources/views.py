"""Trades, transactions and traders defined over the driver's tables.

The driver ships TPC-H-style tables, not trades or transactions, so both are
views with the same column roles, value tiers and null pattern (FIXTURES.md
§2). They are narrow projections: Catalyst prunes the scan to the columns a
query uses and pushes filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_table

# Fixed values of the fixture mapping (FIXTURES.md §2).
CURRENCIES = ["US Dollar", "Euro", "Yuan", "Ruble", "Yen", "UK Pound"]
PAYMENT_FORMATS = ["Reinvestment", "Cheque", "Credit Card", "ACH", "Wire"]
LOOKUP_TRADER_KEYS = [1, 5, 10, 20, 50]


def _pick(key, values: list[str]):
    """``values[key % len(values)]`` as a CASE expression."""
    idx = F.pmod(key, F.lit(len(values)))
    expr = F.when(idx == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(idx == i, F.lit(v))
    return expr


def trades_from_events(events: DataFrame) -> DataFrame:
    """trade_id, exchange (null every 211th), trader_id, amount_usd (null every
    137th, value x 1000), event_time."""
    eid = F.col("event_id")
    amount = (F.col("value").cast("decimal(18,2)") * F.lit(1000)).cast("double")
    return events.select(
        eid.alias("trade_id"),
        F.when(eid % 211 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("exchange"),
        F.col("user_id").alias("trader_id"),
        F.when(eid % 137 == 0, F.lit(None).cast("double")).otherwise(amount).alias("amount_usd"),
        F.col("ts").alias("event_time"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(read_table(spark, sf_dir, "events"))


def transactions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Canonical transaction columns (``schemas.TRANSACTION_SCHEMA``)."""
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    minutes = ((ok * 37 + ln * 101) % 1440).cast("int")
    ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))
    return lineitem.select(
        F.date_format(ts, "yyyy/MM/dd HH:mm").alias("ts"),
        sk.cast("int").alias("from_bank"),
        F.concat(F.lit("A"), pk.cast("string")).alias("from_account"),
        (ok % 50).cast("int").alias("to_bank"),
        F.concat(F.lit("B"), ok.cast("string")).alias("to_account"),
        F.when(ok % 997 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice")).alias("amount_received"),
        _pick(pk, CURRENCIES).alias("receiving_currency"),
        F.col("l_extendedprice").alias("amount_paid"),
        _pick(sk, CURRENCIES).alias("payment_currency"),
        _pick(ln, PAYMENT_FORMATS).alias("payment_format"),
        F.when((ok * 7 + ln) % 1000 == 0, F.lit(1)).otherwise(F.lit(0)).alias("is_laundering_flag"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def traders_from_customer(customer: DataFrame, keys: list[int] | None = None) -> DataFrame:
    """Trader lookup (trader_id, trader_name, risk_level) from ``customer``.

    With ``keys`` it mirrors the reference's five-row lookup; without, every
    customer is a trader (a lookup that grows with the data).
    """
    df = customer
    if keys is not None:
        df = df.filter(F.col("c_custkey").isin(keys))
    return df.select(F.col("c_custkey").alias("trader_id"),
                     F.col("c_name").alias("trader_name"),
                     F.col("c_mktsegment").alias("risk_level"))


def traders(spark: SparkSession, sf_dir: str, keys: list[int] | None = LOOKUP_TRADER_KEYS) -> DataFrame:
    return traders_from_customer(read_table(spark, sf_dir, "customer"), keys)
