"""Schema inference for every table of a batch in one distributed aggregate.

Each payload is exploded into (field, kind) pairs JVM-side; a map-side combined
group-by keeps the shuffle at one row per (table, field, kind) per task, so the
cost does not depend on how rows spread over tables or keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.types import STRICT, is_conflict, json_kind, resolve_kinds
from sluice.sources.envelope import ROUTING_COLUMN


class SchemaConflictError(ValueError):
    """Raised when fields of a batch (or batch and table) disagree on a type."""


def explode_fields(prepared: DataFrame) -> DataFrame:
    """One row per (record, top-level field): table_suffix, reason, pos, field, kind.

    Records with no fields keep one row with NULL field, so every record counts.
    """
    as_map = F.try_variant_get(F.col("payload"), "$", "map<string,variant>")
    return prepared.select(
        "reason",
        ROUTING_COLUMN,
        F.posexplode_outer(as_map).alias("pos", "field", "v"),
    ).select("reason", ROUTING_COLUMN, "pos", "field", json_kind(F.col("v")).alias("kind"))


def observe_fields(prepared: DataFrame) -> DataFrame:
    """Stage 1: count of values and of records per (reason, table, field, kind).

    The suffix of a quarantined record is untrusted text and its fields are not
    used, so such records count per reason only.
    """
    good = F.col("reason").isNull()
    seen = explode_fields(prepared).select(
        "reason", "pos", *[F.when(good, F.col(c)).alias(c) for c in (ROUTING_COLUMN, "field", "kind")]
    )
    return seen.groupBy("reason", ROUTING_COLUMN, "field", "kind").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("n_records"),
    )


def field_types_distinct(prepared: DataFrame) -> DataFrame:
    """Distinct (table, field, type) pairs, without merging them."""
    return (
        explode_fields(prepared)
        .where(F.col("reason").isNull() & F.col("kind").isNotNull())
        .select(ROUTING_COLUMN, "field", F.col("kind").alias("data_type"))
        .distinct()
    )


def infer_schema(observed: DataFrame, mode: str = STRICT) -> DataFrame:
    """Stage 2: merge kinds per (table, field name compared case-insensitively).

    Columns: reason, table_suffix, field, data_type, kinds, spellings,
    n_values, n_records, conflict. ``data_type`` is NULL for a field seen only
    as JSON null, and for conflicts under ``strict``. Rows with NULL field carry
    record counts of empty objects and of quarantined rows.
    """
    kinds = F.array_sort(F.collect_set("kind"))
    spellings = F.array_sort(F.collect_set("field"))
    merged = observed.groupBy("reason", ROUTING_COLUMN, F.lower("field").alias("field_key")).agg(
        kinds.alias("kinds"),
        spellings.alias("spellings"),
        F.sum(F.when(F.col("kind").isNotNull(), F.col("n_values")).otherwise(F.lit(0))).alias("n_values"),
        F.sum("n_records").alias("n_records"),
    )
    return merged.select(
        "reason",
        ROUTING_COLUMN,
        F.get(F.col("spellings"), F.lit(0)).alias("field"),
        resolve_kinds(F.col("kinds"), mode).alias("data_type"),
        "kinds",
        "spellings",
        "n_values",
        "n_records",
        F.when(F.col("field_key").isNotNull(), is_conflict(F.col("kinds"), F.col("spellings"), mode))
        .otherwise(F.lit(False))
        .alias("conflict"),
    )


def at_most_fields(inferred: DataFrame, most: int) -> DataFrame:
    """The inferred rows with ``n_fields`` of their table; of a table with more than ``most`` fields one row each.

    Record counts of all its rows are in that one.
    """
    table = Window.partitionBy("reason", ROUTING_COLUMN)
    few = F.col("n_fields") <= most
    return (
        inferred.withColumn("n_fields", F.count("field").over(table))
        .withColumn("_n", F.sum("n_records").over(table))
        .withColumn("_first", F.min("field").over(table))
        .where(few | F.col("field").eqNullSafe(F.col("_first")))
        .withColumn("n_records", F.when(few, F.col("n_records")).otherwise(F.col("_n")))
        .drop("_n", "_first")
    )


def schema_conflicts(inferred: DataFrame) -> DataFrame:
    """Fields whose kinds or spellings clash: table_suffix, field, types, spellings."""
    return inferred.where(F.col("conflict")).select(
        ROUTING_COLUMN,
        "field",
        F.array_join("kinds", "|").alias("types"),
        F.array_join("spellings", "|").alias("spellings"),
    )


def conflict_message(suffix: str, rows: list) -> str:
    parts = [
        f"'{r['field']}': types {list(r['kinds'])} spellings {list(r['spellings'])}" for r in rows
    ]
    return f"Conflict in table '{suffix}': " + "; ".join(parts)
