"""Structured Streaming wiring: foreachBatch into the multi-table sink.

The checkpoint is required: it is what makes a restart resume instead of
skipping or re-reading, and its query id names the version folders, so a
replayed batch finds its own commit and leaves every table as it was.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sluice.plans.batch import MultiTableSink
from sluice.sources import envelope

# The reference's trigger interval.
DEFAULT_TRIGGER = {"processingTime": "1 minute"}


def query_id(spark, checkpoint_location: str) -> str:
    """Stable id of a streaming query, read from its checkpoint metadata file."""
    row = spark.read.json(f"{checkpoint_location.rstrip('/')}/metadata").first()
    return str(row["id"]).replace("-", "")


def start(
    sink: MultiTableSink,
    stream: DataFrame,
    checkpoint_location: str,
    trigger: dict | None = None,
    query_name: str | None = None,
    batch_time=None,
) -> StreamingQuery:
    """Start ``stream`` (raw or normalised envelope) into ``sink``.

    ``trigger`` takes DataStreamWriter.trigger keywords, e.g.
    ``{"processingTime": "1 minute"}`` (default) or ``{"availableNow": True}``.
    ``batch_time`` (callable of batch id, or None for the driver clock) stamps rows.
    """
    if not checkpoint_location:
        raise ValueError("a checkpoint location is required")
    state: dict[str, str] = {}

    def run(batch_df: DataFrame, batch_id: int) -> None:
        if "writer" not in state:
            state["writer"] = query_id(batch_df.sparkSession, checkpoint_location)
        when = batch_time(batch_id) if callable(batch_time) else None
        sink.process_batch(batch_df, batch_id, writer=state["writer"], batch_time=when)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(**(trigger or DEFAULT_TRIGGER))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def finish(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until a query has ended by itself; raise if it failed.

    There is no limit unless ``timeout_s`` is given; when that runs out the
    query is stopped and TimeoutError raised, never a part returned as a whole.
    """
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the stream did not end within {timeout_s} seconds")
    if query.exception() is not None:
        raise query.exception()
    return query


def run_available(
    sink: MultiTableSink, stream: DataFrame, checkpoint_location: str, batch_time=None, timeout_s: float | None = None
) -> StreamingQuery:
    """Process everything available now and return the finished query."""
    return finish(start(sink, stream, checkpoint_location, {"availableNow": True}, batch_time=batch_time), timeout_s)


def run_topic(spark, sink: MultiTableSink, checkpoint_location: str, trigger: dict | None = None, **kafka: str) -> StreamingQuery:
    """Start the upsert of a Kafka topic into its tables (needs the Kafka connector on the classpath)."""
    return start(sink, envelope.read_kafka_stream(spark, **kafka), checkpoint_location, trigger)


def fixed_time(when: dt.datetime):
    return lambda _batch_id: when
