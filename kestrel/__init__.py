"""kestrel: event analytics on Spark, in batch and Structured Streaming.

Plain functions from DataFrame to DataFrame: ``operators`` (projections, joins,
aggregates, windows, top-k, count windows, keyed state, rules, ordered scans),
``sources`` (tables, derived entities, readers, sinks), ``functions`` (scalar column
functions and their SQL registrations), ``plans`` (registered queries and their DuckDB
oracle) and ``streaming`` (watermarked forms, stateful processors, foreachBatch forms).
"""

__version__ = "0.1.0"
