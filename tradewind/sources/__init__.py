from .files import read_csv, infer_csv_schema, read_parquet, read_table, id_range, schema_report  # noqa: F401
from .lookup import inline_lookup, trader_lookup, DEFAULT_TRADERS  # noqa: F401
from .decode import decode_messages, decode_transactions, decode_report  # noqa: F401
from .kafka import kafka_options, read_kafka_stream, read_kafka_batch  # noqa: F401
from .views import trades, transactions, traders, trades_from_events, transactions_from_lineitem, traders_from_customer  # noqa: F401
