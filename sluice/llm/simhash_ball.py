"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all its variants within half the radius. Two
fingerprints within the radius share a variant (flip one half of the differing
bits of either), so collisions on variants hold every link. With an odd radius
the variants within the smaller half are marked as inner: whoever meets at a
variant with an inner fingerprint is within the radius of it.

The members of a variant are not paired with each other: all hang on the
smallest inner fingerprint there, which keeps the components and costs one link
per member. Fingerprints are distinct, so a variant has at most as many members
as the half ball, whatever the number of copies.

Defined cases
-------------
* null or empty text, or one of blanks only: fingerprint 0, linked like any other.
* fewer words than the shingle: the whole sequence is the one shingle.
* null ``doc_id``: an id above all others; a component of null ids has id null.
* repeated rows: one result row each; ties and equal texts share a fingerprint.
* empty table: no rows. Extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import ref, stage_table
from sluice.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
HASH_SEED = 42
_CHUNK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist())
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > n, bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprint_udf(shingle: int):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) if t is not None else 0 for t in texts], dtype="int64")

    return of


def _masks(radius: int) -> list[int]:
    """All 64-bit words with at most ``radius`` ones, as signed numbers."""
    found = []
    for k in range(radius + 1):
        for bits in combinations(range(64), k):
            mask = sum(1 << b for b in bits)
            found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def ball_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links (u, v) that connect all distinct ``fp`` of ``prints`` within ``radius`` bits."""
    inner, outer = radius // 2, radius - radius // 2
    masks = F.array(*[F.lit(m) for m in _masks(outer)])
    variants = prints.select("fp", F.explode(masks).alias("mask")).select(
        "fp",
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"),
        (F.bit_count("mask") > inner).alias("outer"),
    )
    members = Window.partitionBy("variant").orderBy("outer", "fp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = variants.select(
        "fp", F.first("fp").over(members).alias("hub"), F.first("outer").over(members).alias("hub_outer")
    )
    pairs = met.where(~F.col("hub_outer") & (F.col("fp") != F.col("hub"))).select("fp", "hub").distinct()
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= radius
    return pairs.where(near).select(F.col("fp").alias("u"), F.col("hub").alias("v"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (long), component_id (smallest doc_id reachable) per document."""
    printed = stage_table(
        docs.select(
            ref("doc_id").alias("doc_id"),
            fingerprint_udf(shingle)(F.coalesce(ref("text").cast("string"), F.lit("")).cast("binary")).alias("fp"),
        ),
        "simhash",
    )
    prints = stage_table(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(ball_links(prints.select("fp"), radius))
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return printed.join(classes, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """16 lowercase hex digits of a 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest ``doc_id``.

    Rows of one ``doc_id`` are one document: it goes when none of them stands
    for its group. Documents with a null id cannot be told apart and stay.
    """
    gone = (
        simhash_components(docs, shingle, radius)
        .groupBy("doc_id")
        .agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stands"))
        .where(~F.col("stands"))
        .select(F.col("doc_id").alias("_gone"))
    )
    return docs.join(gone, ref("doc_id") == F.col("_gone"), "left_anti")
