from .windows import windowed_trade_stats, flatten_window, with_event_time, TRADE_WATERMARK, TRADE_WINDOW  # noqa: F401
from .sinks import (trigger_options, batch_writer, start_batch_sink, start_file_sink,  # noqa: F401
                    start_console_sink, start_foreach, run_until_done, last_wins, compact_batches, latest_batch, BATCH_COL)
from .sources import write_message_log, read_message_stream, read_table_stream  # noqa: F401
from .jobs import decoded_trades, trade_windows, enriched_transaction_stream  # noqa: F401
from .replay import ranked, read_replay, remove_log, write_replay_log  # noqa: F401
from .stateful import SESSION_CONF, distinct_messages, trader_sessions, validity, versioned_join  # noqa: F401
from .commits import (Interrupted, commit, committed, committed_writer, crash_once, interrupt, read_committed,  # noqa: F401
                      read_manifest, read_snapshot, rewritten_bytes, snapshot_writer, vacuum_snapshot)
