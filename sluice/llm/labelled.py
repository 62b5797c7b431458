"""Labelled training rows: which documents a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ref, text_of


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id has the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, bound: int) -> DataFrame:
    """text, label of at most ``bound`` labelled documents per class outside fold 0.

    The sample of a class is the documents with the smallest hashes of their id,
    so reruns agree. Only ids and hashes are sorted; the texts are joined to the
    chosen ids. Null labels are left out; of repeated labels the largest counts.
    """
    marks = (
        labels.select(ref("doc_id").alias("_id"), ref(label).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & F.col("_id").isNotNull() & (fold(F.col("_id"), folds) != 0))
        .groupBy("_id")
        .agg(F.max("label").alias("label"))
        .withColumn("_h", F.xxhash64("_id"))
    )
    chosen = None
    for value in (0, 1):
        part = marks.where(F.col("label") == value).orderBy("_h", "_id").limit(bound)
        chosen = part if chosen is None else chosen.unionByName(part)
    return docs.select(ref("doc_id").alias("doc_id"), text_of().alias("text")).join(
        chosen, F.col("doc_id") == F.col("_id")
    ).select("text", "label", F.col("_h").alias("order"))
