"""Keyed upsert as DataFrame algebra: last record per key, then replace by key.

An upsert by key (matched rows replaced whole, others inserted) is
``(target rows whose key is not in the batch) UNION ALL (batch rows)``; a NULL key
never matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.types import quote

# The order that decides which record of a key is the latest.
RECENCY_ORDER = ["kafka_ts", "kafka_partition", "kafka_offset"]


def dedupe_latest(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Keep the latest record per key; rows with a NULL key are all kept.

    ``max_by`` over a group-by combines map-side, so a key holding a large share
    of the batch is reduced to one row per task before the shuffle (a window
    would sort every row of that key in one task).
    """
    order = order or RECENCY_ORDER
    k = F.col(quote(key))
    cols = [F.col(quote(c)) for c in df.columns]
    latest = (
        df.where(k.isNotNull())
        .groupBy(k.alias("__key"))
        .agg(F.max_by(F.struct(*cols), F.struct(*[F.col(quote(c)) for c in order])).alias("__row"))
        .select(*[F.col("__row").getField(c).alias(c) for c in df.columns])
    )
    return latest.unionByName(df.where(k.isNull()))


def key_set(batch: DataFrame, key: str, broadcast: bool = False) -> DataFrame:
    """Distinct non-NULL keys of a batch: the probe and anti-join side of an upsert.

    Taken from the batch itself, not from its deduplicated form (same keys, and a
    hash aggregate on one column instead of a sort aggregate on whole rows); the
    distinct combines map-side, so a hot key costs one row per task. ``broadcast``
    is for callers that have measured the keys, repeats included, and found them
    under their limit; a hash relation needs no distinct, and so no shuffle.
    """
    k = F.col(quote(key))
    keys = batch.where(k.isNotNull()).select(k)
    return F.broadcast(keys) if broadcast else keys.distinct()


def upsert_rows(
    target: DataFrame, batch: DataFrame, key: str, keys: DataFrame | None = None, keys_broadcast: bool = False
) -> DataFrame:
    """Target after an upsert of a deduplicated batch, as one lazy plan.

    Only the batch key set is joined (``keys``, default ``key_set(batch, key)``).
    Where it is broadcast one anti join over one scan keeps the NULL keys as
    well. In a shuffle join rows with a NULL key, which can never match, skip
    the join, so that a large NULL-key population cannot pile up in one task.
    """
    k = F.col(quote(key))
    keys = keys if keys is not None else key_set(batch, key)
    on = k == F.col("__key")
    named = keys.select(F.col(quote(key)).alias("__key"))
    if keys_broadcast:
        kept = target.join(F.broadcast(named), on, "left_anti")
    else:
        kept = target.where(k.isNotNull()).join(named, on, "left_anti").unionByName(target.where(k.isNull()))
    return kept.unionByName(batch.select(*[F.col(quote(c)) for c in target.columns]))


def touched_values(
    target: DataFrame, batch: DataFrame, key: str, column: str | list[str], keys: DataFrame | None = None
) -> DataFrame:
    """Distinct ``column`` values (or value tuples) of target rows whose key occurs in the batch."""
    k = F.col(quote(key))
    cols = [F.col(quote(c)) for c in ([column] if isinstance(column, str) else column)]
    keys = keys if keys is not None else key_set(batch, key)
    named = keys.select(F.col(quote(key)).alias("__key"))
    return (
        target.where(k.isNotNull())
        .select(k.alias("__stored"), *cols)
        .join(named, F.col("__stored") == F.col("__key"), "left_semi")
        .select(*cols)
        .distinct()
    )


def merge_into(batch: DataFrame, table: str, key: str, since=None):
    """Row-level upsert for catalogs that have one (Iceberg, Delta): the writer, not yet run.

    ``since`` bounds the time of the stored rows that are matched, which lets the
    catalog leave out older files.
    """
    on = F.col(f"{table}.{quote(key)}") == F.col(f"source.{quote(key)}")
    if since is not None:
        on = on & (F.col(f"{table}.`kafka_ts`") >= F.lit(since))
    return (
        batch.alias("source").mergeInto(table, on)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
    )
