from .scalars import (  # noqa: F401
    amount_tier, laundering_flag, whale_flag, parse_pattern_time, parse_iso_time,
    hour_of_day, day_of_week, nan_to_null, message_key, format_transaction_time,
    hex_id, padded_id, round_money, ingest_stamp, money_sum, money_avg,
    HIGH_TIER_ABOVE, MEDIUM_TIER_ABOVE, WHALE_ABOVE, TRANSACTION_TIME_FORMAT,
)
