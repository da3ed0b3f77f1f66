from .clean import (whale_trades, require, drop_incomplete, clean_trades, null_counts,  # noqa: F401
                    quality_report, fill_nulls, head)
from .enrich import enrich_transactions, with_processing_time  # noqa: F401
from .stats import (row_count, exchange_stats, top_row, top_exchange, group_count,  # noqa: F401
                    share_of_total, tier_stats, weekday_stats, hour_stats, describe_column,
                    amount_summary, trade_summary, frequency_profile, label_rate, flag_tally)
from .joins import lookup_join, unmatched  # noqa: F401
from .messages import encode_messages, encode_transactions, encode_trades, replay_cycles  # noqa: F401
