"""Projections: decode and flatten payloads, stamp, align to a table, diff schemas."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.types import ddl, quote, struct_ddl
from sluice.sources.envelope import META_COLUMNS, ROUTING_COLUMN

# Columns the engine adds next to the payload.
INGEST_TIME_COLUMN = "ingested_to_iceberg"
DATE_COLUMN = "kafka_date"
BATCH_COLUMN = "ingest_batch"
BUCKET_COLUMN = "key_bucket"
PAYLOAD_PREFIX = "payload_"


def reserved_names(ingest_time_column: str = INGEST_TIME_COLUMN) -> set[str]:
    return {
        *(c.lower() for c in META_COLUMNS),
        "value",
        ROUTING_COLUMN,
        ingest_time_column.lower(),
        DATE_COLUMN,
        BATCH_COLUMN,
        BUCKET_COLUMN,
        "raw_value",
        "reason",
    }


def column_name(field: str, reserved: set[str]) -> str:
    """Payload field to column name; a clash with an envelope column gets a prefix.

    A field that already is such a prefixed name gets one more, so no two fields
    share a column.
    """
    bare = field.lower()
    while bare.startswith(PAYLOAD_PREFIX):
        bare = bare[len(PAYLOAD_PREFIX) :]
    return PAYLOAD_PREFIX + field if bare in reserved else field


@dataclass(frozen=True)
class FieldPlan:
    field: str  # spelling in the payload
    column: str  # target column name
    data_type: str  # type to extract the value as (DDL)


def flatten(rows: DataFrame, fields: list[FieldPlan]) -> DataFrame:
    """Envelope columns plus one typed column per planned payload field.

    The VARIANT parsed once at routing time is cast straight to a struct of the
    planned types, so no record is parsed twice; casts are ANSI (a value that
    does not fit raises instead of turning NULL).
    """
    cols = [F.col(c) for c in META_COLUMNS]
    if fields:
        struct = F.variant_get(F.col("payload"), "$", struct_ddl([(f.field, f.data_type) for f in fields]))
        cols += [struct.getField(f.field).alias(f.column) for f in fields]
    return rows.select(*cols)


def decode_json(df: DataFrame, schema: T.StructType, reserved: set[str] | None = None) -> DataFrame:
    """Parse text ``value`` with a given schema and spread its fields (``from_json``)."""
    reserved = reserved if reserved is not None else reserved_names()
    parsed = F.from_json(F.col("value").cast("string"), schema)
    keep = [c for c in df.columns if c not in ("value", ROUTING_COLUMN)]
    return df.select(
        *[F.col(quote(c)) for c in keep],
        *[parsed.getField(f.name).alias(column_name(f.name, reserved)) for f in schema.fields],
    )


def stamp_ingest_time(df: DataFrame, when: dt.datetime, column: str = INGEST_TIME_COLUMN) -> DataFrame:
    return df.withColumn(column, F.lit(when).cast("timestamp"))


def with_date_partition(df: DataFrame, fallback: str | None = INGEST_TIME_COLUMN) -> DataFrame:
    """Day of the record time, the partition column of target tables; a record
    without a time takes the day of the batch (a partition value is never NULL)."""
    day = F.to_date(F.col("kafka_ts"))
    if fallback and fallback in df.columns:
        day = F.coalesce(day, F.to_date(F.col(fallback)))
    return df.withColumn(DATE_COLUMN, day)


def with_key_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Bucket of the key's text, the inner partition column of merge tables.

    Text, so that an integer key keeps its bucket when its column is widened.
    Rows without a key are dealt by their record identity.
    """
    k = F.col(quote(key))
    record = F.xxhash64("kafka_topic", "kafka_partition", "kafka_offset")
    hashed = F.when(k.isNull(), record).otherwise(F.xxhash64(k.cast("string")))
    return df.withColumn(BUCKET_COLUMN, F.pmod(hashed, F.lit(buckets)).cast("int"))


def _lower_map(names: list[str]) -> dict[str, str]:
    return {n.lower(): n for n in names}


def align_to_schema(df: DataFrame, table_schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """Table order with typed NULLs for missing columns; extra columns last.

    Names compare case-insensitively; the table's spelling wins.
    """
    present = _lower_map(df.columns)
    table_keys = {f.name.lower() for f in table_schema.fields}
    cols = []
    for f in table_schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(quote(src)).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c.lower() not in table_keys]
    return df.select(*cols, *[F.col(quote(c)) for c in extra]), extra


def reorder_to_schema(df: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Table order for the columns present, then the extra ones; no NULL fill: ``align_to_schema`` without what it adds."""
    aligned, _extra = align_to_schema(df, table_schema)
    have = _lower_map(df.columns)
    return df.select(*[F.col(quote(have[c.lower()])) for c in aligned.columns if c.lower() in have])


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(
        [(f.name, ddl(f.dataType), i) for i, f in enumerate(schema.fields)],
        "col_name string, data_type string, ordinal int",
    )


def schema_diff(spark: SparkSession, batch_schema: T.StructType, table_schema: T.StructType) -> DataFrame:
    """Columns only in the batch (``extra``), only in the table (``missing``), or
    in both with different types (``type_mismatch``)."""
    b = schema_rows(spark, batch_schema).select(
        F.lower("col_name").alias("k"), F.col("col_name").alias("b_name"), F.col("data_type").alias("batch_type")
    )
    t = schema_rows(spark, table_schema).select(
        F.lower("col_name").alias("k"), F.col("col_name").alias("t_name"), F.col("data_type").alias("table_type")
    )
    j = b.join(t, "k", "full_outer")
    status = (
        F.when(F.col("t_name").isNull(), F.lit("extra"))
        .when(F.col("b_name").isNull(), F.lit("missing"))
        .when(F.col("batch_type") != F.col("table_type"), F.lit("type_mismatch"))
    )
    return j.select(
        F.coalesce("t_name", "b_name").alias("field"), status.alias("status"), "batch_type", "table_type"
    ).where(F.col("status").isNotNull())
