"""

Every query reads ``events`` from ``sf_dir`` in full, turns it into envelope
records (``sluice.sources.events_feed``) and runs one operator of the sink on
them. Queries that write do so into a fresh database and folder under the
session's ``spark.checkpoint.dir``. The SQL oracles work directly on
``events``, so they share no code path with the engine.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import MultiTableSink, SchemaConflictError, SinkConfig
from sluice.functions.types import WIDEN
from sluice.operators import infer, merge, route, shape
from sluice.plans import counts, tables
from sluice.session import apply_required_conf, scratch_path
from sluice.sources import envelope
from sluice.sources import events_feed as feed
from sluice.streaming import sink as streaming

SMOKE_DIR = "/root/testdata/sf0.001"
# Fixed batch time for stamped rows.
BATCH_TIME = dt.datetime(2024, 6, 1)
PAYLOAD_TYPES = {"amount": "double", "k": "bigint", "detail": "string", "is_paid": "boolean"}


# -- helpers ---------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_required_conf(spark)
    # events.ts is TIMESTAMP_NTZ; the envelope wants TIMESTAMP, and day partitions
    # follow the session zone, so pin UTC as the oracles do.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return feed.read_events(spark, sf_dir)


def _sink(spark: SparkSession, label: str, **config) -> MultiTableSink:
    database = f"sq_{label}_{uuid.uuid4().hex[:10]}"
    root = scratch_path(spark, label)
    # ``events`` is one file: spread its records over the cluster's cores before parsing.
    config.setdefault("min_partitions", spark.sparkContext.defaultParallelism)
    # A day of ``events`` is far below one file, so a day is one bucket unless a query says otherwise.
    config.setdefault("key_buckets", 1)
    return MultiTableSink(spark, SinkConfig(database=database, root=f"{root}/warehouse", **config))


def _prepared(spark: SparkSession, sf_dir: str, env: DataFrame | None = None) -> DataFrame:
    env = env if env is not None else feed.to_envelope(_events(spark, sf_dir))
    return route.prepare(route.spread(envelope.normalise(env), spark.sparkContext.defaultParallelism))


def _table_suffixes(sink: MultiTableSink) -> list[str]:
    db = sink.config.database
    names = [t.name for t in sink.spark.catalog.listTables(db)]
    quarantine = sink.config.table_prefix + sink.config.quarantine_table
    return sorted(n for n in names if n != quarantine)


def _all_tables(sink: MultiTableSink, columns: list[str]) -> DataFrame:
    """Every routed table, projected to the same columns (NULL where absent)."""
    frames = []
    for suffix in _table_suffixes(sink):
        df = sink.read(suffix)
        have = {c.lower(): c for c in df.columns}
        cols = [F.lit(suffix).alias("table_suffix")]
        for c in columns:
            if c in have:
                cols.append(F.col(have[c]).alias(c))
            else:
                cols.append(F.lit(None).cast(PAYLOAD_TYPES.get(c, "bigint")).alias(c))
        frames.append(df.select(*cols))
    return reduce(DataFrame.unionByName, frames)


def _stacked(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _score_envelope(ev: DataFrame) -> DataFrame:
    """Payloads whose ``score`` is an integer for value < 100 and a fraction above."""
    score = F.when(F.col("value") < 100, F.col("user_id").cast("string")).otherwise(
        F.concat(F.col("user_id").cast("string"), F.lit(".5"))
    )
    text = F.concat(F.lit('{"unique_id":'), F.col("event_id").cast("string"), F.lit(',"score":'), score, F.lit("}"))
    return feed.to_envelope(ev, value_text=text)


def _merged_events(spark: SparkSession, sf_dir: str, label: str) -> MultiTableSink:
    sink = _sink(spark, label)
    sink.process_batch(feed.to_envelope(_events(spark, sf_dir)), 0, writer="q", batch_time=BATCH_TIME)
    return sink


# -- queries ---------------------------------------------------------------


def q_envelope_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = envelope.normalise(feed.to_envelope(_events(spark, sf_dir)))
    return n.select(
        F.col("kafka_key").cast("string").alias("kafka_key"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        F.unix_micros("kafka_ts").alias("kafka_ts_us"),
        "kafka_ts_type",
        "table_suffix",
    )


def q_payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text itself; the fraction, which engines print differently, beside it."""
    t = envelope.payload_text(envelope.normalise(feed.to_envelope(_events(spark, sf_dir))))
    return t.select(
        F.col("kafka_offset").alias("event_id"),
        F.col("table_suffix").alias("event_type"),
        F.regexp_replace("value", '"amount":[^,}]*', '"amount":#').alias("text"),
        F.get_json_object("value", "$.amount").cast("double").alias("amount"),
    )


def q_decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = envelope.normalise(feed.to_envelope(_events(spark, sf_dir)))
    schema = T.StructType.fromDDL("unique_id BIGINT, user_id BIGINT, amount DOUBLE, k BIGINT, detail STRING, is_paid BOOLEAN")
    return shape.decode_json(n, schema).select("kafka_offset", *schema.names)


def q_route_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.route_suffixes(_prepared(spark, sf_dir))


def q_route_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.route_filter(_prepared(spark, sf_dir), "error").select(
        F.col("kafka_offset").alias("event_id"), "kafka_partition", "table_suffix"
    )


def _per_table(prepared: DataFrame, sink: MultiTableSink, rows_of) -> DataFrame:
    """Apply ``rows_of(suffix, flattened rows)`` to every routed table and stack the results.

    Parsed once and kept, as each table reads it again.
    """
    prepared = prepared.sortWithinPartitions("table_suffix").persist(StorageLevel.MEMORY_AND_DISK)
    inferred = infer.infer_schema(infer.observe_fields(prepared)).where(F.col("reason").isNull()).collect()
    frames = []
    for suffix in sorted({r["table_suffix"] for r in inferred}):
        plans = sink.plan_fields(suffix, [r for r in inferred if r["table_suffix"] == suffix], None)
        flat = shape.flatten(route.route_filter(prepared, suffix), plans)
        have = {c.lower() for c in flat.columns}
        missing = [F.lit(None).cast(t).alias(c) for c, t in PAYLOAD_TYPES.items() if c not in have]
        frames.append(rows_of(suffix, flat.select(*flat.columns, *missing)))
    return reduce(DataFrame.unionByName, frames)


def q_payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _sink(spark, "flatten")

    def rows_of(suffix: str, flat: DataFrame) -> DataFrame:
        return flat.select(
            F.lit(suffix).alias("table_suffix"),
            F.col("kafka_key").cast("string").alias("kafka_key"),
            "kafka_offset",
            "unique_id",
            "user_id",
            *PAYLOAD_TYPES,
        )

    return _per_table(_prepared(spark, sf_dir), sink, rows_of)


def q_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    inferred = infer.infer_schema(infer.observe_fields(_prepared(spark, sf_dir)))
    return inferred.where(
        F.col("reason").isNull() & F.col("field").isNotNull() & F.col("data_type").isNotNull()
    ).select("table_suffix", "field", "data_type", F.col("n_values").alias("n_rows"))


def q_schema_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir, _score_envelope(_events(spark, sf_dir)))
    return infer.schema_conflicts(infer.infer_schema(infer.observe_fields(prepared))).select(
        "table_suffix", "field", "types"
    )


def q_infer_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir, _score_envelope(_events(spark, sf_dir)))
    inferred = infer.infer_schema(infer.observe_fields(prepared), WIDEN)
    return inferred.where(F.col("field").isNotNull()).select("table_suffix", "field", "data_type")


def q_field_types_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir, _score_envelope(_events(spark, sf_dir)))
    return infer.field_types_distinct(prepared)


def _tables_and_rows(spark: SparkSession, sf_dir: str, label: str):
    """All events merged into their tables, and per table the rows of the same events once more."""
    sink = _merged_events(spark, sf_dir, label)
    # Read by the inference and once per table: parsed once. The frames returned read it, so it stays cached.
    prepared = _prepared(spark, sf_dir).sortWithinPartitions(envelope.ROUTING_COLUMN).persist(StorageLevel.MEMORY_AND_DISK)
    inferred = [r for r in infer.infer_schema(infer.observe_fields(prepared)).collect() if r["reason"] is None]
    rows = {}
    for suffix in _table_suffixes(sink):
        plans = sink.plan_fields(suffix, [r for r in inferred if r["table_suffix"] == suffix], None)
        flat = shape.flatten(route.route_filter(prepared, suffix), plans)
        rows[suffix] = shape.with_date_partition(shape.stamp_ingest_time(flat, BATCH_TIME))
    return sink, rows


def q_schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch schema of every table against the stored schema of every table."""
    sink, rows = _tables_and_rows(spark, sf_dir, "diff")
    return _stacked(
        shape.schema_diff(spark, batch.schema, sink.read(stored).schema).select(
            F.lit(suffix).alias("batch_table"), F.lit(stored).alias("stored_table"), "*"
        )
        for suffix, batch in rows.items()
        for stored in rows
    )


def _with_payload(df: DataFrame, suffix: str) -> DataFrame:
    """Table, position of the payload columns, and the payload columns (NULL where absent)."""
    order = ",".join(c for c in df.columns if c in PAYLOAD_TYPES or c in ("unique_id", "user_id"))
    missing = [F.lit(None).cast(t).alias(c) for c, t in PAYLOAD_TYPES.items() if c not in df.columns]
    return df.select(F.lit(suffix).alias("table_suffix"), F.lit(order).alias("columns"), "*", *missing).select(
        "table_suffix", "columns", "kafka_offset", "unique_id", "user_id", *PAYLOAD_TYPES
    )


def q_align_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every table aligned to the stored schema of ``purchase``."""
    sink, rows = _tables_and_rows(spark, sf_dir, "align")
    stored = sink.read("purchase").schema
    return _stacked(_with_payload(shape.align_to_schema(df, stored)[0], suffix) for suffix, df in rows.items())


def q_reorder_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every table in the column order of ``purchase``, without its missing columns."""
    sink, rows = _tables_and_rows(spark, sf_dir, "reorder")
    stored = sink.read("purchase").schema
    return _stacked(_with_payload(shape.reorder_to_schema(df, stored), suffix) for suffix, df in rows.items())


def _stored_schemas(spark: SparkSession, sink: MultiTableSink) -> DataFrame:
    return _stacked(
        shape.schema_rows(spark, spark.table(sink.table(s)).schema).select(F.lit(s).alias("table_suffix"), "*") for s in _table_suffixes(sink)
    )


def q_create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_schemas(spark, _merged_events(spark, sf_dir, "create"))


FIRST_TYPES = ["error", "purchase"]  # first batch of the single-table scenarios; the rest follow


def _two_batches_one_table(spark: SparkSession, sf_dir: str, label: str, **config) -> MultiTableSink:
    """Every event routed to one table ``mixed``: error and purchase first, then the rest."""
    ev = _events(spark, sf_dir)
    sink = _sink(spark, label, **config)
    mixed = F.lit("mixed")
    first = F.coalesce(F.col("event_type").isin(*FIRST_TYPES), F.lit(False))
    sink.process_batch(feed.to_envelope(ev.where(first), suffix=mixed), 0, "q", BATCH_TIME)
    sink.process_batch(feed.to_envelope(ev.where(~first), suffix=mixed), 1, "q", BATCH_TIME)
    return sink


def q_alter_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_schemas(spark, _two_batches_one_table(spark, sf_dir, "alter"))


def q_partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of every merge table, and of one append table that took two batches."""
    sink = _merged_events(spark, sf_dir, "layout")
    appended = _two_batches_one_table(spark, sf_dir, "layouta", mode="append")
    parts = [(s, sink.read(s)) for s in _table_suffixes(sink)] + [("mixed", appended.read("mixed"))]
    days = _stacked(
        df.select(F.lit(s).alias("table_suffix"), F.col(shape.DATE_COLUMN).cast("string").alias("kafka_date")) for s, df in parts
    )
    return days.groupBy("table_suffix", "kafka_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _merged_events(spark, sf_dir, "props")
    return _stacked(
        tables.table_properties(spark, sink.table(s))
        .where(F.col("key").startswith("sluice."))
        .select(F.lit(s).alias("table_suffix"), "key", "value")
        for s in _table_suffixes(sink)
    )


def q_ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _merged_events(spark, sf_dir, "stamp")
    return _stacked(
        sink.read(s).select(
            F.lit(s).alias("table_suffix"), "unique_id", F.unix_micros(sink.config.ingest_time_column).alias("ingested_us")
        )
        for s in _table_suffixes(sink)
    )


def q_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _two_batches_one_table(spark, sf_dir, "append", mode="append")
    return sink.read("mixed").select("kafka_offset", "unique_id", "user_id", *PAYLOAD_TYPES)


def q_batch_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch holding every event and its update: the latest record per key."""
    ev = _events(spark, sf_dir)
    both = feed.to_envelope(ev).unionByName(feed.update_envelope(ev))
    sink = _sink(spark, "dedupe")

    def rows_of(suffix: str, flat: DataFrame) -> DataFrame:
        latest = merge.dedupe_latest(flat, "unique_id")
        return latest.select(F.lit(suffix).alias("table_suffix"), "unique_id", "kafka_offset", *PAYLOAD_TYPES)

    return _per_table(_prepared(spark, sf_dir, both), sink, rows_of)


def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    sink = _sink(spark, "upsert")
    sink.process_batch(feed.to_envelope(ev), 0, "q", BATCH_TIME)
    sink.process_batch(feed.update_envelope(ev), 1, "q", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "user_id", "kafka_offset", "amount", "k", "detail", "is_paid"])


def q_merge_upsert_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``merge_upsert``, the events in four segments of the time range, one batch each, then the updates."""
    ev = _events(spark, sf_dir)
    sink = _sink(spark, "segments", key_buckets=2)
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = ev.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    step = (bounds["hi"] - bounds["lo"]) // 4 + 1
    segment = F.coalesce(F.floor((ts - F.lit(bounds["lo"])) / F.lit(step)), F.lit(0))
    for b in range(4):
        sink.process_batch(feed.to_envelope(ev.where(segment == b)), b, "q", BATCH_TIME)
    sink.process_batch(feed.update_envelope(ev), 4, "q", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "user_id", "kafka_offset", "amount", "k", "detail", "is_paid"])


def q_merge_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's batch comes again after a backfill has replaced rows of it: it changes nothing."""
    ev = _events(spark, sf_dir)
    sink = _sink(spark, "writers", key_buckets=2)
    sink.process_batch(feed.to_envelope(ev), 0, "stream", BATCH_TIME)
    sink.process_batch(feed.update_envelope(ev), 0, "backfill", BATCH_TIME)
    sink.process_batch(feed.to_envelope(ev), 0, "stream", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "user_id", "kafka_offset", "amount", "k", "detail", "is_paid"])


def q_append_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches appended: each once."""
    ev = _events(spark, sf_dir)
    sink = _sink(spark, "awriters", mode="append")
    for batch, writer in ((feed.to_envelope(ev), "stream"), (feed.update_envelope(ev), "backfill"), (feed.to_envelope(ev), "stream")):
        sink.process_batch(batch, 0, writer, BATCH_TIME)
    return _all_tables(sink, ["unique_id", "kafka_offset", "amount", "k"])


def q_merge_time_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that come within the bound replace rows; those that come ten years later stand beside them."""
    ev = _events(spark, sf_dir)
    sink = _sink(spark, "bound", match_days=1)
    sink.process_batch(feed.to_envelope(ev), 0, "q", BATCH_TIME)
    late = F.coalesce(F.col("event_id") % 2 == 1, F.lit(False))
    sink.process_batch(feed.update_envelope(ev.where(~late)), 1, "q", BATCH_TIME)
    later = feed.update_envelope(ev.where(late)).withColumn("timestamp", F.expr("timestamp + interval 3650 days"))
    sink.process_batch(later, 2, "q", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "kafka_offset"])


def q_merge_wide_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys beyond 64 bits stay apart, over an insert and an update batch."""
    ev = _events(spark, sf_dir)
    key = F.col("event_id").cast("decimal(38,0)") + F.lit("18446744073709551616").cast("decimal(38,0)")
    sink = _sink(spark, "wide", key_buckets=3)
    for b, (rows, update) in enumerate(((ev, False), (ev.where(feed.is_update()), True))):
        text = feed.payload_json(feed.payload_fields(update) | {"unique_id": key.cast("decimal(38,0)")})
        shift = feed.UPDATE_OFFSET_SHIFT if update else 0
        sink.process_batch(feed.to_envelope(rows, value_text=text, offset_shift=shift), b, "q", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "kafka_offset", "amount", "k"]).withColumn("unique_id", F.col("unique_id").cast("string"))


def q_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    mid = feed.time_midpoint_us(ev)
    sink = _sink(spark, "insert")
    early = F.coalesce(feed.before(mid), F.lit(False))
    sink.process_batch(feed.to_envelope(ev.where(early)), 0, "q", BATCH_TIME)
    sink.process_batch(feed.to_envelope(ev.where(~early)), 1, "q", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "kafka_offset"])


def q_merge_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    fields = feed.payload_fields()
    fields["unique_id"] = F.when(F.col("value") >= 5, F.col("event_id"))
    text = feed.payload_json(fields)
    sink = _sink(spark, "nullkey")
    sink.process_batch(feed.to_envelope(ev, value_text=text), 0, "q", BATCH_TIME)
    resend = ev.where(F.col("value") < 5)
    sink.process_batch(feed.to_envelope(resend, value_text=text, offset_shift=feed.UPDATE_OFFSET_SHIFT), 1, "q", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "user_id", "kafka_offset"])


def q_merge_replaces_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    sink = _sink(spark, "replace")
    sink.process_batch(feed.to_envelope(ev), 0, "q", BATCH_TIME)
    slim = feed.payload_json({"unique_id": F.col("event_id"), "user_id": F.col("user_id")})
    upd = feed.to_envelope(ev.where(feed.is_update()), value_text=slim, offset_shift=feed.UPDATE_OFFSET_SHIFT)
    sink.process_batch(upd, 1, "q", BATCH_TIME)
    return _all_tables(sink, ["unique_id", "amount", "k", "detail", "is_paid"])


def _damaged_envelope(ev: DataFrame) -> DataFrame:
    """Records with value < 10 damaged or odd, by the unit of their value:

    0 malformed, 1 no header, 2 not an object, 3 bad suffix, 4 an object after a
    newline (good), 5 a suffix that ends in a newline, 6 dotted and clashing
    names (good), 7 an empty field name, 8 a suffix that no catalog could hold,
    9 an object with more fields than a table may get.
    """
    kind = F.floor("value")
    good = feed.payload_json(feed.payload_fields())
    many = "".join(f',"f{i}":1' for i in range(SinkConfig.max_fields))
    key = F.col("event_id").cast("string")
    text = (
        F.when(kind == 0, F.substring(good, 1, 10))
        .when(kind == 2, F.concat(F.lit("["), key, F.lit("]")))
        .when(kind == 4, F.concat(F.lit("\n\t "), good))
        .when(kind == 6, F.concat(F.lit('{"a.b":1,"kafka_ts":2,"payload_kafka_ts":3,"unique_id":'), key, F.lit("}")))
        .when(kind == 7, F.concat(F.lit('{"":1,"unique_id":'), key, F.lit("}")))
        .when(kind == 9, F.concat(F.lit('{"unique_id":'), key, F.lit(many), F.lit("}")))
        .otherwise(good)
    )
    suffix = (
        F.when(kind == 3, F.lit("bad-suffix"))
        .when(kind == 5, F.concat(F.col("event_type"), F.lit("\n")))
        .when(kind == 8, F.lit("x" * 300))
        .otherwise(F.col("event_type"))
    )
    header = F.struct(F.lit("table_suffix").alias("key"), suffix.cast("binary").alias("value"))
    headers = F.when(kind == 1, F.array().cast(envelope.RAW_ENVELOPE["headers"].dataType)).otherwise(F.array(header))
    return feed.to_envelope(ev, value_text=text, headers=headers)


def _damaged_in_two_batches(spark: SparkSession, sf_dir: str, label: str) -> MultiTableSink:
    ev = _events(spark, sf_dir)
    sink = _sink(spark, label)
    odd = F.coalesce(F.col("event_id") % 2 == 1, F.lit(False))
    sink.process_batch(_damaged_envelope(ev.where(odd)), 0, "q", BATCH_TIME)
    sink.process_batch(_damaged_envelope(ev.where(~odd)), 1, "q", BATCH_TIME)
    return sink


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _damaged_in_two_batches(spark, sf_dir, "quarantine")
    return spark.table(sink.quarantine_table()).select("kafka_offset", "table_suffix", "reason")


def q_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tables of the same batches hold: dotted and clashing names have columns of their own."""
    sink = _damaged_in_two_batches(spark, sf_dir, "oddnames")
    return _stacked(
        sink.read(s).select(
            F.lit(s).alias("table_suffix"),
            "unique_id",
            F.col("`a.b`").alias("a_b"),
            "payload_kafka_ts",
            "payload_payload_kafka_ts",
        )
        for s in _table_suffixes(sink)
    )


def q_null_no_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON null is no evidence of a type."""
    score = F.when(F.col("value") < 50, F.lit("null")).otherwise(F.col("user_id").cast("string"))
    text = F.concat(F.lit('{"unique_id":'), F.col("event_id").cast("string"), F.lit(',"never":null,"score":'), score, F.lit("}"))
    prepared = _prepared(spark, sf_dir, feed.to_envelope(_events(spark, sf_dir), value_text=text))
    inferred = infer.infer_schema(infer.observe_fields(prepared))
    return inferred.where(F.col("field").isNotNull()).select("table_suffix", "field", "data_type", F.col("n_values").alias("n_rows"))


def q_case_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spellings of one field are a conflict."""
    name = F.when(F.col("value") < 50, F.lit("id")).otherwise(F.lit("ID"))
    text = F.concat(F.lit('{"'), name, F.lit('":'), F.col("event_id").cast("string"), F.lit("}"))
    prepared = _prepared(spark, sf_dir, feed.to_envelope(_events(spark, sf_dir), value_text=text))
    return infer.schema_conflicts(infer.infer_schema(infer.observe_fields(prepared))).select("table_suffix", "types", "spellings")


def q_stored_type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions are refused by an integer column, table by table; what was stored stays."""
    ev = _events(spark, sf_dir)
    sink = _sink(spark, "types")
    for b, half in enumerate(("", ".5")):
        text = F.concat(F.lit('{"unique_id":'), F.col("event_id").cast("string"), F.lit(',"score":'), F.col("user_id").cast("string"), F.lit(half + "}"))
        batch = feed.to_envelope(ev, value_text=text, offset_shift=b * feed.UPDATE_OFFSET_SHIFT)
        try:
            sink.process_batch(batch, b, "q", BATCH_TIME)
        except SchemaConflictError as refused:
            message = str(refused)
    return _stacked(
        sink.read(s).select(
            F.lit(s).alias("table_suffix"), "unique_id", "score", "kafka_offset", F.lit(f"'{s}'" in message).alias("refused")
        )
        for s in _table_suffixes(sink)
    )


def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of a repeated key of one object wins."""
    key = F.col("event_id").cast("string")
    text = F.concat(F.lit('{"unique_id":'), key, F.lit(',"a":-1,"a":'), F.col("user_id").cast("string"), F.lit("}"))
    prepared = _prepared(spark, sf_dir, feed.to_envelope(_events(spark, sf_dir), value_text=text))
    plan = [shape.FieldPlan("unique_id", "unique_id", "BIGINT"), shape.FieldPlan("a", "a", "BIGINT")]
    return shape.flatten(route.good_rows(prepared), plan).select("unique_id", "a")


def q_kafka_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = envelope.kafka_encode(feed.to_envelope(_events(spark, sf_dir)))
    h = F.get(F.col("headers"), F.lit(0))
    return enc.select(
        "key",
        h.getField("key").alias("header_key"),
        h.getField("value").cast("string").alias("header_value"),
        F.get_json_object("value", "$.user_id").cast("bigint").alias("user_id"),
    )


def _roundtrip_columns(n: DataFrame) -> DataFrame:
    return n.select(
        F.col("kafka_key").cast("string").alias("kafka_key"),
        "kafka_offset",
        "kafka_partition",
        "table_suffix",
        F.unix_micros("kafka_ts").alias("kafka_ts_us"),
        F.get_json_object(F.col("value").cast("string"), "$.user_id").cast("bigint").alias("user_id"),
    )


def q_json_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json") + "/records"
    envelope.write_json(feed.to_envelope(_events(spark, sf_dir)), path)
    return _roundtrip_columns(envelope.normalise(envelope.read_json(spark, path)))


def q_stream_json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "jsonstream")
    envelope.write_json(feed.to_envelope(_events(spark, sf_dir)), f"{base}/records")
    stream = envelope.normalise(envelope.read_json_stream(spark, f"{base}/records"))
    q = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    streaming.finish(q)
    return _roundtrip_columns(spark.read.parquet(f"{base}/out"))


def _stream_two_runs(spark: SparkSession, sf_dir: str, label: str, mode: str) -> MultiTableSink:
    """First run: all events; restart on the same checkpoint: the update records."""
    ev = _events(spark, sf_dir)
    base = scratch_path(spark, label)
    sink = _sink(spark, label, mode=mode)
    envelope.write_json(feed.to_envelope(ev), f"{base}/records")
    stamp = streaming.fixed_time(BATCH_TIME)
    streaming.run_available(sink, envelope.read_json_stream(spark, f"{base}/records"), f"{base}/checkpoint", stamp)
    envelope.write_json(feed.update_envelope(ev), f"{base}/records")
    streaming.run_available(sink, envelope.read_json_stream(spark, f"{base}/records"), f"{base}/checkpoint", stamp)
    return sink


def q_stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _stream_two_runs(spark, sf_dir, "smerge", "merge")
    return _all_tables(sink, ["unique_id", "user_id", "kafka_offset", "amount", "k", "detail", "is_paid"])


def q_stream_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of files taken a few at a time: events, then their updates, over a restart."""
    ev = _events(spark, sf_dir)
    base = scratch_path(spark, "sbacklog")
    sink = _sink(spark, "sbacklog")
    stamp = streaming.fixed_time(BATCH_TIME)
    for batch in (feed.to_envelope(ev), feed.update_envelope(ev)):
        envelope.write_json(batch.repartition(4, "offset"), f"{base}/records")
        stream = envelope.read_json_stream(spark, f"{base}/records", max_files_per_trigger=2)
        streaming.run_available(sink, stream, f"{base}/checkpoint", stamp)
    return _all_tables(sink, ["unique_id", "user_id", "kafka_offset", "amount", "k", "detail", "is_paid"])


def q_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _stream_two_runs(spark, sf_dir, "sappend", "append")
    return _all_tables(sink, ["unique_id", "kafka_offset", "amount", "k"])


def q_count_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table and payload column the rows that have it; ``k`` and ``amount`` are NULL below 5."""
    fields = feed.payload_fields()
    for name in ("k", "amount"):
        fields[name] = F.when(F.col("value") >= 5, fields[name])
    sink = _sink(spark, "notnull")
    sink.process_batch(feed.to_envelope(_events(spark, sf_dir), value_text=feed.payload_json(fields)), 0, "q", BATCH_TIME)
    frames = []
    for s in _table_suffixes(sink):
        df = sink.read(s)
        columns = sorted(c for c in df.columns if c in PAYLOAD_TYPES or c in ("unique_id", "user_id"))
        frames.append(counts.not_null_counts(df, columns).limit(len(columns)).select(F.lit(s).alias("table_suffix"), "field", "n"))
    return _stacked(frames)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "envelope_normalise": q_envelope_normalise,
    "payload_text": q_payload_text,
    "route_suffixes": q_route_suffixes,
    "route_filter": q_route_filter,
    "payload_flatten": q_payload_flatten,
    "infer_schema": q_infer_schema,
    "infer_widen": q_infer_widen,
    "schema_conflicts": q_schema_conflicts,
    "field_types_distinct": q_field_types_distinct,
    "schema_diff": q_schema_diff,
    "align_to_table": q_align_to_table,
    "reorder_to_table": q_reorder_to_table,
    "create_table": q_create_table,
    "alter_add_columns": q_alter_add_columns,
    "partition_layout": q_partition_layout,
    "table_properties": q_table_properties,
    "append_evolve": q_append_evolve,
    "batch_dedupe": q_batch_dedupe,
    "merge_upsert": q_merge_upsert,
    "merge_upsert_segments": q_merge_upsert_segments,
    "merge_writers": q_merge_writers,
    "append_writers": q_append_writers,
    "merge_time_bound": q_merge_time_bound,
    "stream_backlog": q_stream_backlog,
    "merge_insert_only": q_merge_insert_only,
    "merge_null_key": q_merge_null_key,
    "merge_replaces_row": q_merge_replaces_row,
    "quarantine": q_quarantine,
    "kafka_encode": q_kafka_encode,
    "json_sink_roundtrip": q_json_sink_roundtrip,
    "stream_json_source": q_stream_json_source,
    "stream_append": q_stream_append,
    "stream_merge": q_stream_merge,
    "count_not_null": q_count_not_null,
    "decode_json": q_decode_json,
    "ingest_stamp": q_ingest_stamp,
    "merge_wide_keys": q_merge_wide_keys,
    "odd_names": q_odd_names,
    "null_no_evidence": q_null_no_evidence,
    "case_twins": q_case_twins,
    "stored_type_check": q_stored_type_check,
    "duplicate_keys": q_duplicate_keys,
}


# -- oracles ---------------------------------------------------------------

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_UPD = "value >= 100"
_ENVELOPE_COLUMNS = """CAST(event_id AS VARCHAR) AS kafka_key, event_id AS kafka_offset,
  CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_type AS table_suffix, epoch_us(ts) AS kafka_ts_us,
  user_id"""
_PAYLOAD = f"""CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type IN ('click', 'view') THEN {_K} END AS k,
  CASE WHEN event_type = 'error' THEN props END AS detail,
  CASE WHEN event_type = 'signup' THEN value > 10 END AS is_paid"""
_UPSERT = f"""SELECT event_type AS table_suffix, event_id AS unique_id, user_id,
  CASE WHEN {_UPD} THEN event_id + 1000000 ELSE event_id END AS kafka_offset,
  CASE WHEN event_type = 'purchase' THEN (CASE WHEN {_UPD} THEN value * 2 ELSE value END) END AS amount,
  CASE WHEN event_type IN ('click', 'view') THEN {_K} + (CASE WHEN {_UPD} THEN 1 ELSE 0 END) END AS k,
  CASE WHEN event_type = 'error' THEN props END AS detail,
  CASE WHEN event_type = 'signup' THEN (CASE WHEN {_UPD} THEN NOT (value > 10) ELSE value > 10 END) END AS is_paid
FROM events"""
_SCHEMA_HEAD = [
    ("kafka_key", "BINARY"),
    ("kafka_topic", "STRING"),
    ("kafka_partition", "INT"),
    ("kafka_offset", "BIGINT"),
    ("kafka_ts", "TIMESTAMP"),
    ("kafka_ts_type", "INT"),
]


_META_ROWS = ", ".join(f"('{n}', '{t}', {i})" for i, (n, t) in enumerate(_SCHEMA_HEAD))
# Types of the payload fields as the events themselves show them, per table.
_FIELDS = f"""docs AS (
  SELECT event_type, json_object('unique_id', event_id, 'user_id', user_id,
    'amount', CASE WHEN event_type = 'purchase' THEN value END,
    'k', CASE WHEN event_type IN ('click', 'view') THEN {_K} END,
    'detail', CASE WHEN event_type = 'error' THEN props END,
    'is_paid', CASE WHEN event_type = 'signup' THEN value > 10 END) AS doc
  FROM events),
json_fields AS (SELECT event_type, unnest(json_keys(doc)) AS field, doc FROM docs),
typed AS (SELECT event_type, field, json_type(doc, '$."' || field || '"') AS jt FROM json_fields),
fields AS (
  SELECT event_type, field, CASE WHEN jt IN ('BIGINT', 'UBIGINT') THEN 'BIGINT' WHEN jt = 'DOUBLE' THEN 'DOUBLE'
    WHEN jt = 'BOOLEAN' THEN 'BOOLEAN' WHEN jt = 'ARRAY' THEN 'ARRAY<STRING>' ELSE 'STRING' END AS data_type,
    count(*) AS n_rows
  FROM typed WHERE jt IS NOT NULL AND jt <> 'NULL' GROUP BY ALL)"""
_TAIL_ROWS = "('ingested_to_iceberg', 'TIMESTAMP', 0), ('kafka_date', 'DATE', {0}), ('key_bucket', 'INT', {1}), ('ingest_batch', 'STRING', {2})"
_ALL_PAYLOAD = f"""event_id AS kafka_offset, event_id AS unique_id, user_id, {_PAYLOAD}"""


_ORACLES: dict[str, str] = {
    "envelope_normalise": """SELECT CAST(event_id AS VARCHAR) AS kafka_key, 'events' AS kafka_topic,
  CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, epoch_us(ts) AS kafka_ts_us,
  0 AS kafka_ts_type, event_type AS table_suffix FROM events""",
    "payload_text": f"""SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS amount,
  '{{"unique_id":' || event_id || ',"user_id":' || user_id
  || CASE WHEN event_type = 'purchase' THEN ',"amount":#' WHEN event_type IN ('click', 'view') THEN ',"k":' || {_K}
     WHEN event_type = 'error' THEN ',"detail":' || to_json(props) WHEN event_type = 'signup' THEN ',"is_paid":' || (value > 10) ELSE '' END
  || '}}' AS text FROM events""",
    "route_suffixes": "SELECT event_type AS table_suffix, count(*) AS n_rows FROM events GROUP BY event_type",
    "route_filter": """SELECT event_id, CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_type AS table_suffix
FROM events WHERE event_type = 'error'""",
    "payload_flatten": f"""SELECT event_type AS table_suffix, CAST(event_id AS VARCHAR) AS kafka_key, event_id AS kafka_offset,
  event_id AS unique_id, user_id, {_PAYLOAD} FROM events""",
    "infer_schema": f"WITH {_FIELDS} SELECT event_type AS table_suffix, field, data_type, n_rows FROM fields",
    "infer_widen": """SELECT event_type AS table_suffix, 'score' AS field,
  CASE WHEN bool_or(value < 100) AND NOT bool_or(value >= 100) THEN 'BIGINT' ELSE 'DOUBLE' END AS data_type
FROM events GROUP BY event_type
UNION ALL SELECT DISTINCT event_type, 'unique_id', 'BIGINT' FROM events""",
    "schema_conflicts": """SELECT event_type AS table_suffix, 'score' AS field, 'BIGINT|DOUBLE' AS types
FROM events GROUP BY event_type HAVING bool_or(value < 100) AND bool_or(value >= 100)""",
    "field_types_distinct": """SELECT DISTINCT event_type AS table_suffix, 'score' AS field,
  CASE WHEN value < 100 THEN 'BIGINT' ELSE 'DOUBLE' END AS data_type FROM events
UNION SELECT DISTINCT event_type, 'unique_id', 'BIGINT' FROM events""",
    "schema_diff": f"""WITH {_FIELDS}, pairs AS (
  SELECT b.event_type AS bt, s.event_type AS st FROM (SELECT DISTINCT event_type FROM events) b, (SELECT DISTINCT event_type FROM events) s)
SELECT p.bt AS batch_table, p.st AS stored_table, f.field, 'extra' AS status, f.data_type AS batch_type, CAST(NULL AS VARCHAR) AS table_type
FROM pairs p JOIN fields f ON f.event_type = p.bt
WHERE NOT EXISTS (SELECT 1 FROM fields g WHERE g.event_type = p.st AND g.field = f.field)
UNION ALL
SELECT p.bt, p.st, f.field, 'missing', NULL, f.data_type FROM pairs p JOIN fields f ON f.event_type = p.st
WHERE NOT EXISTS (SELECT 1 FROM fields g WHERE g.event_type = p.bt AND g.field = f.field)
UNION ALL
SELECT p.bt, p.st, f.field, 'type_mismatch', f.data_type, g.data_type
FROM pairs p JOIN fields f ON f.event_type = p.bt JOIN fields g ON g.event_type = p.st AND g.field = f.field WHERE f.data_type <> g.data_type""",
    "align_to_table": f"""WITH {_FIELDS} SELECT event_type AS table_suffix, 'amount,unique_id,user_id'
  || coalesce((SELECT string_agg(',' || f.field, '' ORDER BY lower(f.field)) FROM fields f WHERE f.event_type = e.event_type
     AND f.field NOT IN (SELECT field FROM fields WHERE event_type = 'purchase')), '') AS "columns", {_ALL_PAYLOAD} FROM events e""",
    "reorder_to_table": f"""WITH {_FIELDS} SELECT event_type AS table_suffix,
  (SELECT string_agg(f.field, ',' ORDER BY f.field NOT IN (SELECT field FROM fields WHERE event_type = 'purchase'), lower(f.field))
   FROM fields f WHERE f.event_type = e.event_type) AS "columns", {_ALL_PAYLOAD} FROM events e""",
    "create_table": f"""WITH {_FIELDS}, n AS (SELECT event_type, count(*) AS n FROM fields GROUP BY event_type)
SELECT event_type AS table_suffix, v.col_name, v.data_type, CAST(v.i AS INTEGER) AS ordinal
FROM n, (VALUES {_META_ROWS}) AS v(col_name, data_type, i)
UNION ALL
SELECT event_type, field, data_type, CAST(5 + row_number() OVER (PARTITION BY event_type ORDER BY lower(field)) AS INTEGER) FROM fields
UNION ALL
SELECT event_type, v.col_name, v.data_type, CAST(6 + n + v.i AS INTEGER)
FROM n, (VALUES {_TAIL_ROWS.format(1, 2, 3)}) AS v(col_name, data_type, i)""",
    "alter_add_columns": f"""WITH {_FIELDS}, f AS (SELECT field, min(data_type) AS data_type, bool_or(event_type IN ('error', 'purchase')) AS first FROM fields GROUP BY field),
n AS (SELECT count(*) FILTER (first) AS a, count(*) AS b FROM f)
SELECT 'mixed' AS table_suffix, v.col_name, v.data_type, CAST(v.i AS INTEGER) AS ordinal FROM (VALUES {_META_ROWS}) AS v(col_name, data_type, i)
UNION ALL SELECT 'mixed', field, data_type, CAST(5 + row_number() OVER (ORDER BY lower(field)) AS INTEGER) FROM f WHERE first
UNION ALL SELECT 'mixed', field, data_type, CAST(6 + n.a + row_number() OVER (ORDER BY lower(field)) AS INTEGER) FROM f, n WHERE NOT first
UNION ALL SELECT 'mixed', v.col_name, v.data_type, CAST(6 + CASE WHEN v.i = 0 THEN n.a ELSE n.b + v.i END AS INTEGER)
FROM n, (VALUES {_TAIL_ROWS.format(1, 2, 3)}) AS v(col_name, data_type, i)""",
    "partition_layout": """SELECT event_type AS table_suffix, CAST(CAST(ts AS DATE) AS VARCHAR) AS kafka_date, count(*) AS n_rows
FROM events GROUP BY ALL
UNION ALL SELECT 'mixed', CAST(CAST(ts AS DATE) AS VARCHAR), count(*) FROM events GROUP BY ALL""",
    "table_properties": """SELECT event_type AS table_suffix, key, value FROM (SELECT DISTINCT event_type FROM events),
(VALUES ('sluice.key', 'unique_id'), ('sluice.mode', 'merge'), ('sluice.buckets', '1'),
  ('sluice.partition', 'kafka_date,key_bucket,ingest_batch')) AS p(key, value)""",
    "append_evolve": f"SELECT event_id AS kafka_offset, event_id AS unique_id, user_id, {_PAYLOAD} FROM events",
    "batch_dedupe": f"""SELECT table_suffix, unique_id, kafka_offset, amount, k, detail, is_paid FROM ({_UPSERT})""",
    "merge_upsert": _UPSERT,
    "merge_upsert_segments": _UPSERT,
    "merge_writers": _UPSERT,
    "append_writers": f"""SELECT event_type AS table_suffix, event_id AS unique_id, event_id AS kafka_offset,
  CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type IN ('click', 'view') THEN {_K} END AS k FROM events
UNION ALL
SELECT event_type, event_id, event_id + 1000000,
  CASE WHEN event_type = 'purchase' THEN value * 2 END,
  CASE WHEN event_type IN ('click', 'view') THEN {_K} + 1 END FROM events WHERE {_UPD}""",
    "merge_time_bound": f"""SELECT event_type AS table_suffix, event_id AS unique_id,
  event_id + CASE WHEN {_UPD} AND event_id % 2 = 0 THEN 1000000 ELSE 0 END AS kafka_offset FROM events
UNION ALL SELECT event_type, event_id, event_id + 1000000 FROM events WHERE {_UPD} AND event_id % 2 = 1""",
    "stream_backlog": _UPSERT,
    "merge_insert_only": "SELECT event_type AS table_suffix, event_id AS unique_id, event_id AS kafka_offset FROM events",
    "merge_null_key": """SELECT event_type AS table_suffix, CASE WHEN value >= 5 THEN event_id END AS unique_id, user_id,
  event_id AS kafka_offset FROM events
UNION ALL
SELECT event_type, CAST(NULL AS BIGINT), user_id, event_id + 1000000 FROM events WHERE value < 5""",
    "merge_replaces_row": f"""SELECT event_type AS table_suffix, event_id AS unique_id,
  CASE WHEN event_type = 'purchase' AND NOT ({_UPD}) THEN value END AS amount,
  CASE WHEN event_type IN ('click', 'view') AND NOT ({_UPD}) THEN {_K} END AS k,
  CASE WHEN event_type = 'error' AND NOT ({_UPD}) THEN props END AS detail,
  CASE WHEN event_type = 'signup' AND NOT ({_UPD}) THEN value > 10 END AS is_paid
FROM events""",
    "quarantine": """SELECT event_id AS kafka_offset,
  CASE floor(value) WHEN 1 THEN NULL WHEN 3 THEN 'bad-suffix' WHEN 5 THEN event_type || chr(10)
    WHEN 8 THEN repeat('x', 300) ELSE event_type END AS table_suffix,
  CASE floor(value) WHEN 0 THEN 'malformed' WHEN 1 THEN 'unroutable' WHEN 2 THEN 'not_object' WHEN 7 THEN 'invalid_field'
       WHEN 9 THEN 'too_many_fields' ELSE 'invalid_suffix' END AS reason
FROM events WHERE floor(value) IN (0, 1, 2, 3, 5, 7, 8, 9)""",
    "kafka_encode": """SELECT CAST(event_id AS VARCHAR) AS key, 'table_suffix' AS header_key, event_type AS header_value, user_id
FROM events""",
    "json_sink_roundtrip": f"SELECT {_ENVELOPE_COLUMNS} FROM events",
    "stream_json_source": f"SELECT {_ENVELOPE_COLUMNS} FROM events",
    "stream_append": f"""SELECT event_type AS table_suffix, event_id AS unique_id, event_id AS kafka_offset,
  CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type IN ('click', 'view') THEN {_K} END AS k FROM events
UNION ALL
SELECT event_type, event_id, event_id + 1000000,
  CASE WHEN event_type = 'purchase' THEN value * 2 END,
  CASE WHEN event_type IN ('click', 'view') THEN {_K} + 1 END FROM events WHERE {_UPD}""",
    "stream_merge": _UPSERT,
    "count_not_null": f"""WITH {_FIELDS} SELECT f.event_type AS table_suffix, f.field,
  CAST(sum(CASE WHEN f.field IN ('k', 'amount') AND value < 5 THEN 0 ELSE 1 END) AS BIGINT) AS n
FROM fields f JOIN events e ON e.event_type = f.event_type GROUP BY ALL""",
    "decode_json": f"SELECT {_ALL_PAYLOAD} FROM events",
    "ingest_stamp": "SELECT event_type AS table_suffix, event_id AS unique_id, epoch_us(TIMESTAMP '2024-06-01') AS ingested_us FROM events",
    "merge_wide_keys": f"""SELECT event_type AS table_suffix, CAST(event_id::HUGEINT + 18446744073709551616 AS VARCHAR) AS unique_id,
  event_id + CASE WHEN {_UPD} THEN 1000000 ELSE 0 END AS kafka_offset,
  CASE WHEN event_type = 'purchase' THEN value * CASE WHEN {_UPD} THEN 2 ELSE 1 END END AS amount,
  CASE WHEN event_type IN ('click', 'view') THEN {_K} + CASE WHEN {_UPD} THEN 1 ELSE 0 END END AS k FROM events""",
    "odd_names": """SELECT event_type AS table_suffix, event_id AS unique_id,
  CAST(CASE WHEN floor(value) = 6 THEN 1 END AS BIGINT) AS a_b,
  CAST(CASE WHEN floor(value) = 6 THEN 2 END AS BIGINT) AS payload_kafka_ts,
  CAST(CASE WHEN floor(value) = 6 THEN 3 END AS BIGINT) AS payload_payload_kafka_ts
FROM events WHERE floor(value) NOT IN (0, 1, 2, 3, 5, 7, 8, 9)""",
    "null_no_evidence": """SELECT event_type AS table_suffix, 'unique_id' AS field, 'BIGINT' AS data_type, count(*) AS n_rows FROM events GROUP BY ALL
UNION ALL SELECT event_type, 'never', NULL, 0 FROM events GROUP BY ALL
UNION ALL SELECT event_type, 'score', CASE WHEN bool_or(value >= 50) THEN 'BIGINT' END, count(*) FILTER (value >= 50) FROM events GROUP BY event_type""",
    "case_twins": """SELECT event_type AS table_suffix, 'BIGINT' AS types, 'ID|id' AS spellings
FROM events GROUP BY event_type HAVING bool_or(value < 50) AND bool_or(value >= 50)""",
    "stored_type_check": """SELECT event_type AS table_suffix, event_id AS unique_id, user_id AS score, event_id AS kafka_offset, true AS refused FROM events""",
    "duplicate_keys": "SELECT event_id AS unique_id, user_id AS a FROM events",
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the streaming multi-table upsert on sf0.001."""
    return q_stream_merge(spark, SMOKE_DIR)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the ``llm`` subpackage, and the corpus pipeline, where they are installed.

    Only their absence is tolerated: any other import error is raised.
    """
    found: dict = {}
    sqls: dict = {}
    try:
        from sluice.llm import oracles as llm_oracles
        from sluice.llm import queries as llm_queries
    except ImportError as missing:
        if missing.name != "sluice.llm":
            raise
        return found, sqls
    found.update(llm_queries.QUERIES)
    sqls.update(llm_oracles.ORACLES)
    try:
        import corpus_pipeline
    except ImportError as missing:
        if missing.name != "corpus_pipeline":
            raise
        return found, sqls
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sqls["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sqls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLES, **_training_data()[1]}
