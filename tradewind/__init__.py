"""Transaction and trade analytics as Spark DataFrame operators.

Subpackages: ``sources`` (scans, lookups, message decode), ``functions``
(column expressions), ``operators`` (cleaning, enrichment, statistics,
joins, messages, generators), ``streaming`` (windowed aggregates and stream
sinks), ``sinks`` (batch writers) and ``plans`` (the named query registry).
"""

__version__ = "0.1.0"
