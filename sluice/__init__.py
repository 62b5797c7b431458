"""sluice: route a stream of keyed JSON records into many tables, with Spark.

Reads a stream or table of envelope records whose first header names the
target table, infers every table's schema in one distributed aggregate,
creates or widens the tables and upserts (or appends) the rows by key.
"""

from sluice.plans.batch import BatchReport, BadRecordError, MultiTableSink, SinkConfig
from sluice.operators.infer import SchemaConflictError

__all__ = ["BatchReport", "BadRecordError", "MultiTableSink", "SinkConfig", "SchemaConflictError"]
