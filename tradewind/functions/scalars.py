"""Scalar column expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions``
only, so it stays inside whole-stage codegen and works unchanged in batch
and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the reference's results.
HIGH_TIER_ABOVE = 10000      # amount > 10000 -> "HIGH"
MEDIUM_TIER_ABOVE = 1000     # amount > 1000  -> "MEDIUM", else "LOW"
TIER_HIGH, TIER_MEDIUM, TIER_LOW = "HIGH", "MEDIUM", "LOW"
FLAG_YES, FLAG_NO = "Yes", "No"
WHALE_ABOVE = 100000         # amount_usd > 100000 is a whale trade
TRANSACTION_TIME_FORMAT = "yyyy/MM/dd HH:mm"
UNKNOWN_KEY = "unknown"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_tier(amount, high_above: float = HIGH_TIER_ABOVE,
                medium_above: float = MEDIUM_TIER_ABOVE) -> Column:
    """HIGH above ``high_above``, MEDIUM above ``medium_above``, else LOW.

    Bounds are strict; a null amount falls through to LOW. A NaN compares
    greater than any number in Spark and so lands in HIGH; ``nan_to_null``
    at decode time removes that case.
    """
    a = _col(amount)
    return (F.when(a > F.lit(high_above), F.lit(TIER_HIGH))
             .when(a > F.lit(medium_above), F.lit(TIER_MEDIUM))
             .otherwise(F.lit(TIER_LOW)))


def laundering_flag(flag) -> Column:
    """X2: "Yes" when the 0/1 label equals 1, otherwise (0, null, other) "No"."""
    f = _col(flag)
    return F.when(f == F.lit(1), F.lit(FLAG_YES)).otherwise(F.lit(FLAG_NO))


def whale_flag(amount, above: float = WHALE_ABOVE) -> Column:
    """Boolean ``amount > above``; null stays null."""
    return _col(amount) > F.lit(above)


def parse_pattern_time(text, fmt: str = TRANSACTION_TIME_FORMAT) -> Column:
    """Parse with a fixed pattern; malformed text gives null, never an error."""
    return F.try_to_timestamp(_col(text), F.lit(fmt))


def parse_iso_time(text) -> Column:
    """Parse an ISO-8601 timestamp string; malformed text gives null."""
    return F.try_to_timestamp(_col(text))


def hour_of_day(ts) -> Column:
    """0-23 in the session time zone."""
    return F.hour(_col(ts))


def day_of_week(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(ts))


def nan_to_null(c) -> Column:
    """Map NaN to null (D5) so a missing amount always tiers as LOW."""
    x = _col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def message_key(c) -> Column:
    """The key as a string; a missing value becomes "unknown"."""
    return F.coalesce(_col(c).cast("string"), F.lit(UNKNOWN_KEY))


def format_transaction_time(ts) -> Column:
    """Render a timestamp as ``yyyy/MM/dd HH:mm``."""
    return F.date_format(_col(ts), TRANSACTION_TIME_FORMAT)


def hex_id(n, width: int = 7) -> Column:
    """Upper-case hex of an integer, left-padded with zeros to ``width``."""
    return F.lpad(F.hex(_col(n).cast("bigint")), width, "0")


def padded_id(prefix: str, n, width: int) -> Column:
    """``prefix`` followed by ``n`` zero-padded to ``width`` digits."""
    return F.format_string(f"{prefix}%0{width}d", _col(n).cast("bigint"))


def round_money(c, digits: int = 2) -> Column:
    """Round half-up to ``digits`` decimals."""
    return F.round(_col(c), digits)


def ingest_stamp() -> Column:
    """ISO-8601 processing stamp (constant within one query/micro-batch)."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def money_sum(c) -> Column:
    """Total of a money column, as a double over the raw values: no digit is
    cut, an infinity stays one, nulls are not counted. The last bits of a
    double sum depend on the order of addition; round for display."""
    return F.sum(_col(c).cast("double"))


def money_avg(c) -> Column:
    """Mean of the values ``money_sum`` adds; null when there are none."""
    return F.avg(_col(c).cast("double"))
