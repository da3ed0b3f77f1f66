from .files import (write_parquet, write_and_verify, write_partitioned, read_partitioned,  # noqa: F401
                    write_csv, CSV_TIMESTAMP_FORMAT)
from .kafka import write_kafka, write_kafka_stream  # noqa: F401
