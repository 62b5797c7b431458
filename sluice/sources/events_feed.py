"""Envelope records derived from the ``events`` table, the input of every check.

Each event becomes one record routed by ``event_type`` (five tables). The JSON
payload has ``unique_id`` (event_id) and ``user_id``; ``purchase`` adds
``amount`` (value), ``click`` and ``view`` add ``k`` (from props), ``error`` adds
``detail`` (props text), ``signup`` adds ``is_paid`` (value > 10). ``to_json``
drops NULL fields, so each table gets its own schema. Offsets are event ids,
partitions ``user_id % 4``, record time ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Feed parameters shared by the Spark queries and their SQL oracles.
TOPIC = "events"
N_PARTITIONS = 4
UPDATE_OFFSET_SHIFT = 1_000_000
UPDATE_MIN_VALUE = 100.0  # records re-sent as updates: value >= this
PAID_MIN_VALUE = 10.0


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def payload_fields(update: bool = False) -> dict[str, Column]:
    """Payload columns; ``update`` doubles amount, bumps k, flips is_paid."""
    t = F.col("event_type")
    value = F.col("value")
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    paid = value > F.lit(PAID_MIN_VALUE)
    return {
        "unique_id": F.col("event_id"),
        "user_id": F.col("user_id"),
        "amount": F.when(t == "purchase", value * F.lit(2.0) if update else value),
        "k": F.when(t.isin("click", "view"), k + F.lit(1) if update else k),
        "detail": F.when(t == "error", F.col("props")),
        "is_paid": F.when(t == "signup", ~paid if update else paid),
    }


def payload_json(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def to_envelope(
    events: DataFrame,
    value_text: Column | None = None,
    offset_shift: int = 0,
    suffix: Column | None = None,
    headers: Column | None = None,
) -> DataFrame:
    """Raw envelope rows (RAW_ENVELOPE layout) for the given events."""
    value_text = value_text if value_text is not None else payload_json(payload_fields())
    suffix = suffix if suffix is not None else F.col("event_type")
    if headers is None:
        headers = F.array(F.struct(F.lit("table_suffix").alias("key"), suffix.cast("binary").alias("value")))
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        value_text.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % F.lit(N_PARTITIONS)).cast("int").alias("partition"),
        (F.col("event_id") + F.lit(offset_shift)).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        headers.alias("headers"),
    )


def is_update(events_value: Column | None = None) -> Column:
    v = events_value if events_value is not None else F.col("value")
    return v >= F.lit(UPDATE_MIN_VALUE)


def update_envelope(events: DataFrame) -> DataFrame:
    """Second batch: events with value >= 100 re-sent with changed fields, later offsets."""
    return to_envelope(events.where(is_update()), payload_json(payload_fields(update=True)), UPDATE_OFFSET_SHIFT)


def time_midpoint_us(events: DataFrame) -> int:
    """Microsecond midpoint of the record times (one scalar aggregate)."""
    row = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("lo"),
                     F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("hi")).first()
    return (row["lo"] + row["hi"]) // 2


def before(midpoint_us: int) -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp")) < F.lit(midpoint_us)
