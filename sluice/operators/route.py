"""Routing: parse once, classify rows, list and filter routing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.types import SUFFIX_PATTERN
from sluice.sources.envelope import META_COLUMNS, ROUTING_COLUMN

# Quarantine reasons.
UNROUTABLE = "unroutable"
INVALID_SUFFIX = "invalid_suffix"
MALFORMED = "malformed"
NOT_OBJECT = "not_object"
INVALID_FIELD = "invalid_field"
TOO_MANY_FIELDS = "too_many_fields"

# Field names that no table column can carry (empty, over 255 characters, control characters).
BAD_FIELD_PATTERN = r"\A\z|\A.{256,}\z|[\x00-\x1F\x7F]"


# Columns that identify a record, used to spread a batch over tasks.
SPREAD_COLUMNS = ("kafka_topic", "kafka_partition", "kafka_offset")


def spread(normalised: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread records over ``partitions`` tasks; ``None`` or 0 leaves the input as it is.

    For inputs that come in few partitions (a topic with few, one large file):
    the caller knows its source, and asking the plan would run part of it. Hash
    on the record's identity, not round-robin: as even (offsets are unique
    within a topic partition, so a hot partition spreads too) and deterministic
    on retry without the local sort round-robin needs.
    """
    if not partitions:
        return normalised
    return normalised.repartition(partitions, *[F.col(c) for c in SPREAD_COLUMNS if c in normalised.columns])


def prepare(normalised: DataFrame, max_suffix: int = 128, max_fields: int = 2_000) -> DataFrame:
    """Parse every payload once into a VARIANT and tag rows that cannot be written.

    Among them are rows whose suffix is longer than ``max_suffix`` characters, as no
    catalog or file system could hold their table, or whose object has more
    than ``max_fields`` fields.

    Output: META_COLUMNS, table_suffix, payload (VARIANT), raw_value (text, kept
    only for bad rows), reason (NULL for good rows).
    """
    text = F.col("value").cast("string")
    parsed = F.try_parse_json(text)
    suffix = F.col(ROUTING_COLUMN)
    # Only an object is a map of names; a column of their own, so that they are read once.
    names = F.col("_names")
    read_names = F.map_keys(F.try_variant_get(F.col("payload"), "$", "map<string,variant>"))
    reason = (
        F.when(suffix.isNull() | (suffix == ""), F.lit(UNROUTABLE))
        .when(~suffix.rlike(SUFFIX_PATTERN) | (F.length(suffix) > max_suffix), F.lit(INVALID_SUFFIX))
        .when(F.col("payload").isNull(), F.lit(MALFORMED))
        .when(names.isNull(), F.lit(NOT_OBJECT))
        .when(F.exists(names, lambda n: n.rlike(BAD_FIELD_PATTERN)), F.lit(INVALID_FIELD))
        .when(F.size(names) > max_fields, F.lit(TOO_MANY_FIELDS))
    )
    return (
        normalised.select(*META_COLUMNS, ROUTING_COLUMN, "value", parsed.alias("payload"))
        .withColumn("_names", read_names)
        .withColumn("reason", reason)
        .select(
            *META_COLUMNS,
            ROUTING_COLUMN,
            F.when(F.col("reason").isNull(), F.col("payload")).alias("payload"),
            F.when(F.col("reason").isNotNull(), text).alias("raw_value"),
            "reason",
        )
    )


def good_rows(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("reason").isNull())


def bad_rows(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("reason").isNotNull())


def route_suffixes(prepared: DataFrame) -> DataFrame:
    """Distinct routing keys with their row counts (map-side combined)."""
    return good_rows(prepared).groupBy(ROUTING_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))


def route_filter(prepared: DataFrame, suffix: str) -> DataFrame:
    return prepared.where((F.col(ROUTING_COLUMN) == F.lit(suffix)) & F.col("reason").isNull())
