"""Named query registry and its DuckDB oracle."""

from .oracle import ORACLE_SQL as _BATCH_SQL
from .queries import QUERIES as _BATCH_QUERIES
from .stream_oracle import STREAM_ORACLE_SQL
from .stream_queries import STREAM_QUERIES

QUERIES = {**_BATCH_QUERIES, **STREAM_QUERIES}
ORACLE_SQL = {**_BATCH_SQL, **STREAM_ORACLE_SQL}
