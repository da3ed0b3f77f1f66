"""JSON message decode.

Takes any frame with a ``value`` column (binary from Kafka, or string from a
file stand-in), so the same function serves the Kafka source, text files and
tests. PERMISSIVE ``from_json``: a malformed message decodes to all-null
fields and is then removed by the required-field filter (F3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_to_null
from ..schemas import TRANSACTION_RAW_NAMES, TRANSACTION_WIRE_SCHEMA


def decode_messages(messages: DataFrame, schema: T.StructType, required: str,
                    keep_columns: list[str] | None = None,
                    normalize_nan: bool = True) -> DataFrame:
    """value -> string -> struct -> flattened columns; drop rows whose
    ``required`` field is null.

    ``normalize_nan`` turns NaN in double fields into null (D5), so a
    missing amount behaves the same whatever the sender wrote for it.
    ``keep_columns`` carries message columns (e.g. ``key``) alongside.
    """
    keep = [F.col(c) for c in (keep_columns or [])]
    # Parse once: ``inline`` of a one-element array turns the struct into
    # columns inside a Generate node. With a plain ``select("data.*")``
    # Catalyst pushes the required-field filter below the projection and
    # every message is parsed twice (once for the filter, once for output).
    parsed = F.from_json(F.col("value").cast("string"), schema)
    flat = messages.select(*keep, F.inline(F.array(parsed)))
    if normalize_nan:
        doubles = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
        if doubles:
            flat = flat.withColumns({c: nan_to_null(c) for c in doubles})
    return flat.filter(F.col(required).isNotNull())


def decode_transactions(messages: DataFrame, keep_columns: list[str] | None = None) -> DataFrame:
    """S6 for transaction messages: parsed under the wire's names
    (``Timestamp``, ``From Bank``, ``Account.1``, ...), then renamed to ours."""
    flat = decode_messages(messages, TRANSACTION_WIRE_SCHEMA, "Timestamp", keep_columns)
    return flat.toDF(*[TRANSACTION_RAW_NAMES.get(c, c) for c in flat.columns])


def decode_report(messages: DataFrame, schema: T.StructType, required: str) -> DataFrame:
    """One row: messages, and how many of them decode to nothing (malformed,
    or without the required field) and so vanish from the decoded rows."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    lost = F.coalesce(parsed[required].isNull(), F.lit(True))
    return messages.agg(F.count(F.lit(1)).alias("messages"), F.count_if(lost).alias("undecoded"))
