"""Micro-batch plan: route, infer, create or widen, then merge or append per table.

Per batch the records are parsed once and persisted; one aggregate yields
routing keys, every table's schema and the quarantine counts. A new table then
costs one write. A table that holds data costs, before its write, one aggregate
of the batch (buckets, key bytes) and one key-only probe of the buckets that the
batch's keys fall into.

Commits. Each table's properties name the last batch that each writer has
committed, so a batch that comes again is left alone, whoever wrote since. An
append overwrites its own partitions (dynamic partition overwrite). A merge
writes its partitions aside; one statement on the properties commits them, and
the switch of the partitions that follows is finished by whoever comes next if
it was cut short. Writers in one driver take turns on a table; writers in
several drivers need a catalog with row-level merges.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from sluice.functions.types import STRICT, WIDEN, ddl, quote, storable
from sluice.operators.infer import SchemaConflictError, at_most_fields, conflict_message, infer_schema, observe_fields
from sluice.operators.merge import dedupe_latest, key_set, merge_into, touched_values, upsert_rows
from sluice.operators.route import bad_rows, prepare, route_filter, spread
from sluice.operators.shape import (
    BATCH_COLUMN,
    BUCKET_COLUMN,
    DATE_COLUMN,
    INGEST_TIME_COLUMN,
    FieldPlan,
    align_to_schema,
    column_name,
    flatten,
    reserved_names,
    stamp_ingest_time,
    with_date_partition,
    with_key_bucket,
)
from sluice.plans import tables
from sluice.session import apply_required_conf, broadcast_limit, shared_root
from sluice.sources.envelope import META_COLUMNS, ROUTING_COLUMN, normalise

MERGE = "merge"
APPEND = "append"
PARQUET = "parquet"
QUARANTINE = "quarantine"
FAILFAST = "failfast"

# Types of the envelope columns in every target table.
META_TYPES = [
    ("kafka_key", "BINARY"),
    ("kafka_topic", "STRING"),
    ("kafka_partition", "INT"),
    ("kafka_offset", "BIGINT"),
    ("kafka_ts", "TIMESTAMP"),
    ("kafka_ts_type", "INT"),
]


# Partition columns of parquet tables. A merge table has one live
# version (the batch that wrote it) of each day and key bucket; an append table
# has a partition for each day and batch, the unit that a repeated batch overwrites.
MERGE_PARTITIONS = [DATE_COLUMN, BUCKET_COLUMN, BATCH_COLUMN]
APPEND_PARTITIONS = [DATE_COLUMN, BATCH_COLUMN]
# An overwrite of an append table replaces the partitions it writes, no others.
APPEND_OPTIONS = {"partitionOverwriteMode": "dynamic"}
PARTITION_TYPES = {DATE_COLUMN: "DATE", BUCKET_COLUMN: "INT", BATCH_COLUMN: "STRING"}

# Bytes per key entry added to the key width when sizing a broadcast
# (hash relation slot, row header, pointer).
KEY_ENTRY_OVERHEAD = 32

# Table properties that commits use: the last batch of a writer, and
# the merge whose partitions are being switched.
DONE_PROPERTY = "sluice_done."
SWITCH_PROPERTY = "sluice_switch"

# Characters of a table name at most, prefix included (catalogs and file systems have such a bound).
MAX_TABLE_NAME = 128

_LOCKS: dict[str, threading.RLock] = {}


def _turn(table: str) -> threading.RLock:
    """The lock by which this driver's writers take turns on a table."""
    return _LOCKS.setdefault(table, threading.RLock())


class BadRecordError(ValueError):
    """Raised under ``on_bad='failfast'`` when a batch has unroutable or malformed rows."""


@dataclass
class SinkConfig:
    database: str = "default"
    table_prefix: str = ""
    key: str = "unique_id"
    mode: str = MERGE  # merge (upsert by key) or append
    conflicts: str = STRICT  # strict or widen
    on_bad: str = QUARANTINE  # quarantine or failfast
    quarantine_table: str = "_quarantine"
    ingest_time_column: str = INGEST_TIME_COLUMN
    root: str | None = None  # folder for table data; default under spark.checkpoint.dir
    table_format: str = PARQUET  # parquet: copy-on-write commits; iceberg, delta: row-level merge
    max_concurrent_tables: int = 8
    # Spread a batch over so many tasks before parsing, for a source that comes in
    # few partitions. None: parse it in the partitions it has.
    min_partitions: int | None = None
    # The batch key set is broadcast to the probe and the anti join when its measured
    # size is at most this many bytes. None: the session's autoBroadcastJoinThreshold.
    broadcast_keys_max_bytes: int | None = None
    # Key buckets per day of a merge table: the unit that an upsert rewrites. Fixed
    # when a table is created. Choose it so that a bucket of a day is a few files:
    # fewer cost larger rewrites, more cost small files.
    key_buckets: int = 16
    # Records with more top-level fields than this are quarantined, and a table that
    # a batch would give more columns is refused, the others not: schemas are planned
    # on the driver, table by table.
    max_fields: int = 2_000
    # Keys are looked for in days this far from the batch's days at most, in a row-level
    # merge as well; an older row of a key stays beside the new one. None: in all days.
    match_days: int | None = None
    # A batch of at most so many keys is looked for by their values, which row groups'
    # statistics and bloom filters answer without reading them; more keys are joined.
    probe_literal_keys: int = 1_000
    properties: dict[str, str] = field(default_factory=dict)


@dataclass
class BatchReport:
    batch_id: int
    tables: dict[str, int] = field(default_factory=dict)  # suffix -> records routed
    quarantined: dict[str, int] = field(default_factory=dict)  # reason -> records
    skipped: list[str] = field(default_factory=list)  # tables already committed by this batch


class MultiTableSink:
    """Writes a stream (or table) of envelope records into one table per routing key."""

    def __init__(self, spark: SparkSession, config: SinkConfig | None = None):
        self.spark = spark
        self.config = config or SinkConfig()
        if self.config.conflicts not in (STRICT, WIDEN):
            raise ValueError(f"conflicts must be {STRICT!r} or {WIDEN!r}")
        if self.config.mode not in (MERGE, APPEND):
            raise ValueError(f"mode must be {MERGE!r} or {APPEND!r}")
        apply_required_conf(spark)
        self.root = (self.config.root or f"{shared_root(spark)}/sluice/warehouse/{self.config.database}").rstrip("/")
        self.reserved = reserved_names(self.config.ingest_time_column)
        tables.ensure_database(spark, self.config.database)

    # -- names -------------------------------------------------------------

    def table_name(self, suffix: str) -> str:
        return f"{self.config.table_prefix}{suffix}"

    def table(self, suffix: str) -> str:
        return tables.ident(self.config.database, self.table_name(suffix))

    def read(self, suffix: str) -> DataFrame:
        """The table's rows, without the columns that only place them."""
        return self.spark.table(self.table(suffix)).drop(BUCKET_COLUMN, BATCH_COLUMN)

    # -- batch -------------------------------------------------------------

    def process_batch(
        self,
        df: DataFrame,
        batch_id: int,
        writer: str = "batch",
        batch_time: dt.datetime | None = None,
    ) -> BatchReport:
        """Route, infer and write one micro-batch; safe to call again with the same
        ``(writer, batch_id)`` after a failure."""
        spark = df.sparkSession
        apply_required_conf(spark)
        batch_time = batch_time or dt.datetime.now(dt.timezone.utc)
        normalised = normalise(df) if "headers" in df.columns else df
        normalised = spread(normalised, self.config.min_partitions)
        # Sorting by routing key inside each partition (no shuffle) keeps the cached
        # column batches narrow, so each table's scan of the cache skips the others.
        prepared = prepare(
            normalised, MAX_TABLE_NAME - len(self.config.table_prefix), self.config.max_fields
        ).sortWithinPartitions(ROUTING_COLUMN).persist(StorageLevel.MEMORY_AND_DISK)
        report = BatchReport(batch_id)
        try:
            inferred = at_most_fields(infer_schema(observe_fields(prepared), self.config.conflicts), self.config.max_fields).collect()
            per_table: dict[str, list] = {}
            for r in inferred:
                if r["reason"] is not None:
                    report.quarantined[r["reason"]] = report.quarantined.get(r["reason"], 0) + r["n_records"]
                else:
                    per_table.setdefault(r[ROUTING_COLUMN], []).append(r)
            for suffix, rows in per_table.items():
                report.tables[suffix] = sum(r["n_records"] for r in rows)
            if report.quarantined and self.config.on_bad == FAILFAST:
                raise BadRecordError(f"batch {batch_id} has bad records: {report.quarantined}")

            errors: list[str] = []
            failures: list[Exception] = []
            for suffix in self._colliding_suffixes(per_table):
                errors.append(f"table suffix '{suffix}' names the same table as another suffix or the quarantine table")
                del per_table[suffix]

            def run(suffix: str) -> None:
                # One scheduler pool per worker slot: under FAIR scheduling a hot
                # table's large job does not hold back the small tables of the batch
                # (FIFO sessions ignore the pool). Bounded names, no pool per table.
                slot = suffixes.index(suffix) % workers
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"sluice-{slot}")
                try:
                    if not self._write_table(prepared, suffix, per_table[suffix], batch_id, writer, batch_time):
                        report.skipped.append(suffix)
                except (SchemaConflictError, ValueError) as exc:
                    errors.append(str(exc))
                except Exception as exc:  # the other tables of the batch are finished first
                    failures.append(exc)

            suffixes = sorted(per_table)
            jobs = len(suffixes) + (1 if report.quarantined else 0)
            workers = max(1, min(self.config.max_concurrent_tables, jobs))
            # Worker threads inherit the caller's local properties (the job group),
            # so a batch's jobs can be tracked or cancelled together.
            # The quarantine write is independent of the tables: it runs beside them.
            with ThreadPoolExecutor(max_workers=workers) as pool:
                futures = [pool.submit(inheritable_thread_target(spark)(run), s) for s in suffixes]
                if report.quarantined:
                    write_bad = inheritable_thread_target(spark)(self._write_quarantine)
                    futures.append(pool.submit(write_bad, prepared, batch_id, writer, batch_time))
                for f in futures:
                    f.result()
            if failures:
                for also in [*errors, *map(str, failures[1:])]:
                    failures[0].add_note(f"also in this batch: {also}")
                raise failures[0]
            if errors:
                raise SchemaConflictError("; ".join(sorted(errors)))
            return report
        finally:
            prepared.unpersist()

    def _colliding_suffixes(self, per_table: dict) -> list[str]:
        """Suffixes that would share a catalog table (names compare case-insensitively)."""
        seen: dict[str, list[str]] = {}
        for suffix in per_table:
            seen.setdefault(self.table_name(suffix).lower(), []).append(suffix)
        quarantine = (self.config.table_prefix + self.config.quarantine_table).lower()
        out = [s for names in seen.values() if len(names) > 1 for s in names]
        out += seen.get(quarantine, [])
        return sorted(set(out))

    # -- per table plan ----------------------------------------------------

    def plan_fields(self, suffix: str, rows: list, stored: T.StructType | None) -> list[FieldPlan]:
        """Decide column, type and extraction for each payload field of one table."""
        conflicts = [r for r in rows if r["conflict"]]
        if conflicts:
            raise SchemaConflictError(conflict_message(suffix, conflicts))
        stored_by_key = {f.name.lower(): f for f in (stored.fields if stored else [])}
        plans: list[FieldPlan] = []
        problems = []
        for r in sorted((r for r in rows if r["field"] is not None), key=lambda r: r["field"].lower()):
            col = column_name(r["field"], self.reserved)
            have = stored_by_key.get(col.lower())
            if have is not None:
                stored_type = ddl(have.dataType)
                if r["data_type"] is None or storable(r["data_type"], stored_type, self.config.conflicts):
                    plans.append(FieldPlan(r["field"], have.name, stored_type))
                else:
                    problems.append(f"'{r['field']}': batch {r['data_type']} vs table {stored_type}")
            elif r["data_type"] is not None:
                plans.append(FieldPlan(r["field"], col, r["data_type"]))
        if problems:
            raise SchemaConflictError(f"Conflict in table '{suffix}': " + "; ".join(problems))
        if self.config.mode == MERGE:
            key = self.config.key.lower()
            types = [ddl(stored_by_key[key].dataType)] if key in stored_by_key else []
            types += [p.data_type for p in plans if p.column.lower() == key]
            if not types:
                raise ValueError(f"table '{suffix}' has no key column '{self.config.key}' in data or table")
            if types[0] in ("DOUBLE", "FLOAT"):
                raise ValueError(f"table '{suffix}': a fraction ({types[0]}) cannot be the key '{self.config.key}'")
        return plans

    def _partitions(self) -> list[str]:
        """Partition columns of the sink's tables; a row-level format partitions by a transform instead."""
        if self.config.table_format != PARQUET:
            return []
        return MERGE_PARTITIONS if self.config.mode == MERGE else APPEND_PARTITIONS

    def _partition_sql(self) -> list[str]:
        if self.config.table_format == "iceberg":
            return ["days(" + quote("kafka_ts") + ")"]
        return [quote(c) for c in self._partitions()]

    def _ensure_table(self, suffix: str, plans: list[FieldPlan], stored: T.StructType | None) -> T.StructType:
        table, partitions = self.table(suffix), self._partitions()
        if stored is None:
            columns = META_TYPES + [(p.column, p.data_type) for p in plans]
            columns += [(self.config.ingest_time_column, "TIMESTAMP"), *((c, PARTITION_TYPES[c]) for c in partitions)]
            props = {
                "sluice.key": self.config.key,
                "sluice.mode": self.config.mode,
                "sluice.partition": ",".join(self._partition_sql()).replace("`", ""),
            }
            if BUCKET_COLUMN in partitions:
                props["sluice.buckets"] = str(self.config.key_buckets)
            props.update(self.config.properties)
            tables.create_table(
                self.spark,
                table,
                columns,
                self._partition_sql(),
                self._folder(self.table_name(suffix)) if self.config.table_format == PARQUET else None,
                self.config.table_format,
                props,
                APPEND_OPTIONS if partitions == APPEND_PARTITIONS else None,
            )
        else:
            known = {f.name.lower() for f in stored.fields}
            new = sorted(((p.column, p.data_type) for p in plans if p.column.lower() not in known), key=lambda c: c[0].lower())
            tables.add_columns(self.spark, table, new)
        return self.spark.table(table).schema

    def _check_layout(self, suffix: str, props: dict[str, str]) -> None:
        """A stored table keeps the partitions and buckets it was created with."""
        want = ",".join(self._partition_sql()).replace("`", "")
        if props.get("sluice.partition", want) != want:
            raise ValueError(f"table '{suffix}' is partitioned by {props['sluice.partition']}, the sink by {want}")
        buckets = props.get("sluice.buckets")
        if buckets is not None and int(buckets) != self.config.key_buckets:
            raise ValueError(f"table '{suffix}' has {buckets} key buckets, the sink is set to {self.config.key_buckets}")

    def _table_rows(self, prepared: DataFrame, suffix: str, plans: list[FieldPlan], batch_time: dt.datetime) -> DataFrame:
        rows = flatten(route_filter(prepared, suffix), plans)
        rows = stamp_ingest_time(rows, batch_time, self.config.ingest_time_column)
        return with_date_partition(rows, self.config.ingest_time_column) if self._partitions() else rows

    def _write_table(
        self, prepared: DataFrame, suffix: str, rows: list, batch_id: int, writer: str, batch_time: dt.datetime
    ) -> bool:
        """False when an earlier attempt of this batch had committed the table."""
        table, name = self.table(suffix), self.table_name(suffix)
        if rows[0]["n_fields"] > self.config.max_fields:
            raise SchemaConflictError(f"table '{suffix}': more than {self.config.max_fields} fields in one batch")
        with _turn(table):
            exists = tables.table_exists(self.spark, self.config.database, name)
            props = tables.property_map(self.spark, table) if exists else {}
            if exists:
                self._check_layout(suffix, props)
                self._finish_switch(table, name, props.get(SWITCH_PROPERTY))
                if self._is_done(props, writer, batch_id):
                    return False
            stored = self.spark.table(table).schema if exists else None
            plans = self.plan_fields(suffix, rows, stored)
            schema = self._ensure_table(suffix, plans, stored)
            data = self._table_rows(prepared, suffix, plans, batch_time)
            if self.config.table_format != PARQUET:
                self._row_level(table, align_to_schema(data, schema)[0], batch_id, writer)
            elif self.config.mode == APPEND:
                self._append(table, schema, data, batch_id, writer)
            else:
                self._copy_on_write(table, suffix, schema, data, batch_id, writer, has_data=exists)
        return True

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _aside(self, name: str, tag: str) -> str:
        return f"{self._folder(name)}/_v/{tag}"

    # -- commits -----------------------------------------------------------

    @staticmethod
    def _is_done(props: dict[str, str], writer: str, batch_id: int) -> bool:
        """A writer's batches come in order, so its last committed one stands for all before it."""
        return int(props.get(DONE_PROPERTY + writer, -1)) >= batch_id

    def _mark_done(self, table: str, writer: str, batch_id: int, switch: str = "") -> None:
        tables.set_properties(self.spark, table, {DONE_PROPERTY + writer: str(batch_id), SWITCH_PROPERTY: switch})

    def _finish_switch(self, table: str, name: str, tag: str | None) -> None:
        """Point the catalog at the partitions of a committed merge; repeating it changes nothing.

        Every writer does so before it reads the table, so no newer version of a
        bucket can stand beside the merge's.
        """
        if not tag:
            return
        pairs = [DATE_COLUMN, BUCKET_COLUMN]
        written = tables.written_folders(self.spark, f"{self._aside(name, tag)}/data", pairs)
        emptied = tables.written_folders(self.spark, f"{self._aside(name, tag)}/emptied", pairs)
        touched = {*written, *emptied}
        live = tables.live_partitions(self.spark, table, DATE_COLUMN, sorted({d for d, _ in touched}))
        adds = [[[d, b, tag], folder] for (d, b), folder in sorted(written.items())]
        drops = [list(p) for p in sorted(live) if p[:2] in touched and p[2] != tag]
        tables.switch_partitions(self.spark, table, MERGE_PARTITIONS, adds, drops)
        tables.set_properties(self.spark, table, {SWITCH_PROPERTY: ""})

    def _copy_on_write(
        self, table: str, suffix: str, schema: T.StructType, data: DataFrame, batch_id: int, writer: str, has_data: bool
    ) -> None:
        """Rewrite only the key buckets of days that the batch touches, then switch them.

        Touched are the buckets of the batch's rows, and those of stored rows with
        a key of the batch. The stored rows of these buckets, minus the replaced
        keys, and the deduplicated batch go to a fresh folder, which one statement
        commits; then one ADD and one DROP statement. Between the two a reader may
        see both versions of a bucket.
        """
        name, tag = self.table_name(suffix), f"{writer}-{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        key_col = next(f.name for f in schema.fields if f.name.lower() == self.config.key.lower())
        data_schema = T.StructType([f for f in schema.fields if f.name not in (BUCKET_COLUMN, BATCH_COLUMN)])
        aligned = with_key_bucket(align_to_schema(data, data_schema)[0], key_col, self.config.key_buckets)
        batch = result = dedupe_latest(aligned, key_col)
        replaced: list[tuple[str, ...]] = []
        if has_data:
            k = F.col(quote(key_col))
            day = F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN)
            own = aligned.groupBy(day, BUCKET_COLUMN).agg(
                F.count(k).alias("keys"), F.sum(F.octet_length(k.cast("string"))).alias("bytes")
            ).collect()
            touched = {(r[DATE_COLUMN], str(r[BUCKET_COLUMN])) for r in own}
            # An upper bound of the key set in memory: every key counted, its text and an entry.
            size = sum(r["keys"] * KEY_ENTRY_OVERHEAD + (r["bytes"] or 0) for r in own)
            small = self._may_broadcast(size)
            keys = key_set(aligned, key_col, broadcast=small)
            target = self._in_reach(self.spark.table(table), [r[DATE_COLUMN] for r in own])
            # A key is always in the bucket of its text, whatever its day.
            target = target.where(F.col(BUCKET_COLUMN).isin(sorted({r[BUCKET_COLUMN] for r in own if r["keys"]})))
            touched |= {
                (str(r[0]), str(r[1])) for r in self._probe(target, aligned, key_col, keys, sum(r["keys"] for r in own))
            }
            live = tables.live_partitions(self.spark, table, DATE_COLUMN, sorted({d for d, _ in touched}))
            replaced = sorted(p for p in live if p[:2] in touched)
            if replaced:
                stored = self.spark.table(table).where(self._buckets_filter(replaced)).drop(BATCH_COLUMN)
                result = upsert_rows(stored, batch, key_col, keys, small)
        written = self._write_partitioned(result, [DATE_COLUMN, BUCKET_COLUMN], key_col, f"{self._aside(name, tag)}/data")
        # Buckets whose rows all moved to another day are dropped without a successor.
        emptied = {p[:2] for p in replaced} - set(written)
        tables.make_folders(
            self.spark,
            [f"{self._aside(name, tag)}/emptied/{DATE_COLUMN}={d}/{BUCKET_COLUMN}={b}" for d, b in sorted(emptied)],
        )
        self._mark_done(table, writer, batch_id, switch=tag)
        self._finish_switch(table, name, tag)

    def _in_reach(self, target: DataFrame, days: list[str]) -> DataFrame:
        """Stored rows of the days in which a batch's keys are looked for (a partition filter)."""
        if self.config.match_days is None or not days:
            return target
        reach = dt.timedelta(days=self.config.match_days)
        first, last = dt.date.fromisoformat(min(days)) - reach, dt.date.fromisoformat(max(days)) + reach
        return target.where(F.col(DATE_COLUMN).between(F.lit(first), F.lit(last)))

    def _probe(self, target: DataFrame, batch: DataFrame, key: str, keys: DataFrame, n_keys: int) -> list:
        """(day, bucket) pairs of stored rows with a key of the batch."""
        if n_keys > self.config.probe_literal_keys:
            return touched_values(target, batch, key, [DATE_COLUMN, BUCKET_COLUMN], keys).collect()
        k = F.col(quote(key))
        values = [r[0] for r in batch.where(k.isNotNull()).select(k).distinct().collect()]
        return target.where(k.isin(values)).select(DATE_COLUMN, BUCKET_COLUMN).distinct().collect() if values else []

    @staticmethod
    def _buckets_filter(partitions: list[tuple[str, ...]]):
        """Partition predicate of the given (day, bucket) pairs; days with the same buckets share a term."""
        by_day: dict[str, set[int]] = {}
        for d, b, *_ in partitions:
            by_day.setdefault(d, set()).add(int(b))
        days: dict[tuple[int, ...], list[str]] = {}
        for d, buckets in by_day.items():
            days.setdefault(tuple(sorted(buckets)), []).append(d)
        terms = [
            F.col(DATE_COLUMN).isin([dt.date.fromisoformat(d) for d in sorted(ds)]) & F.col(BUCKET_COLUMN).isin(list(buckets))
            for buckets, ds in sorted(days.items())
        ]
        return reduce(or_, terms)

    def _write_partitioned(self, rows: DataFrame, columns: list[str], key: str, path: str) -> dict[tuple[str, ...], str]:
        """Write rows by partition into a fresh folder; partition values -> folder.

        Rebalanced by partition: without it every task writes one file per
        partition it holds; adaptive execution sizes the tasks and splits a hot
        one. Sorted by key inside and with bloom filters on it, so that row groups
        without a wanted key are not read.
        """
        writer = rows.hint("rebalance", *columns).sortWithinPartitions(*columns, quote(key)).write.partitionBy(*columns)
        if re.fullmatch(r"\w+", key):
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
                "parquet.bloom.filter.adaptive.enabled", "true"
            )
        writer.parquet(path)
        return tables.written_folders(self.spark, path, columns)

    def _append(self, table: str, schema: T.StructType, rows: DataFrame, batch_id: int, writer: str) -> None:
        """Overwrite the batch's own partitions, one per day, and mark it as done.

        Partitions that a failed attempt left on days that this one does not write
        are dropped first.
        """
        tag = f"{writer}-{batch_id:012d}"
        left = tables.live_partitions(self.spark, table, BATCH_COLUMN, [tag])
        tables.switch_partitions(self.spark, table, APPEND_PARTITIONS, [], [list(p) for p in left])
        aligned, _ = align_to_schema(rows.withColumn(BATCH_COLUMN, F.lit(tag)), schema)
        aligned.hint("rebalance", DATE_COLUMN).write.insertInto(table, overwrite=True)
        self._mark_done(table, writer, batch_id)

    def _row_level(self, table: str, aligned: DataFrame, batch_id: int, writer: str) -> None:
        """The catalog's own append or merge; the mark set after it keeps a replay from repeating it."""
        if self.config.mode == APPEND:
            aligned.writeTo(table).append()
        else:
            key_col = next(c for c in aligned.columns if c.lower() == self.config.key.lower())
            since = None
            if self.config.match_days is not None:
                oldest = aligned.agg(F.min("kafka_ts").alias("t")).first()["t"]
                since = None if oldest is None else oldest - dt.timedelta(days=self.config.match_days)
            merge_into(dedupe_latest(aligned, key_col), table, key_col, since).merge()
        self._mark_done(table, writer, batch_id)

    def _may_broadcast(self, key_bytes: int) -> bool:
        limit = self.config.broadcast_keys_max_bytes
        if limit is None:
            limit = broadcast_limit(self.spark)
        return 0 <= key_bytes <= limit

    def _write_quarantine(self, prepared: DataFrame, batch_id: int, writer: str, batch_time: dt.datetime) -> None:
        name = self.config.table_prefix + self.config.quarantine_table
        table = self.quarantine_table()
        with _turn(table):
            if not tables.table_exists(self.spark, self.config.database, name):
                columns = META_TYPES + [
                    (ROUTING_COLUMN, "STRING"),
                    ("raw_value", "STRING"),
                    ("reason", "STRING"),
                    (self.config.ingest_time_column, "TIMESTAMP"),
                    *((c, PARTITION_TYPES[c]) for c in APPEND_PARTITIONS),
                ]
                partitions = [quote(c) for c in APPEND_PARTITIONS]
                properties = {"sluice.mode": "quarantine"}
                tables.create_table(
                    self.spark, table, columns, partitions, self._folder(name), PARQUET, properties, APPEND_OPTIONS
                )
            if self._is_done(tables.property_map(self.spark, table), writer, batch_id):
                return
            rows = bad_rows(prepared).select(*META_COLUMNS, ROUTING_COLUMN, "raw_value", "reason")
            stamp = self.config.ingest_time_column
            rows = with_date_partition(stamp_ingest_time(rows, batch_time, stamp), stamp)
            self._append(table, self.spark.table(table).schema, rows, batch_id, writer)

    def quarantine_table(self) -> str:
        return tables.ident(self.config.database, self.config.table_prefix + self.config.quarantine_table)
