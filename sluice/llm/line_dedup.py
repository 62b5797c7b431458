"""Reversible incremental line dedup: sharded cuckoo filters before exact reference counts.

The state of a corpus is three tables, all dealt by the digest of a line's key:

* ``postings`` (shard, digest, doc_id): every document holding the key, once;
* ``counts`` (shard, digest, n_docs, last_doc): the exact reference count and
  the largest document holding the key;
* ``filters`` (shard, cells): one cuckoo filter per shard over the keys that
  are counted. A filter answers "surely new" or "maybe known" and, unlike a
  Bloom filter, forgets a key when its count falls to 0.

``insert`` asks the filters about the distinct keys of a batch; only the maybe
known ones are looked up in the exact counts. ``delete`` takes documents out
again: counts fall, a lost ``last_doc`` is found anew from the postings of the
keys concerned, and keys without a document leave filter and counts. Inserting
and then deleting a batch gives back the state before it.

A filter only saves lookups, so its false positives never change a result.
Batches are combined per key before the shuffle: a line on a third of all
documents is one row per task.

Defined cases
-------------
* null or empty text: one empty line, which has no key long enough to go.
* null ``doc_id``: one document for the counts, below every other id; what each of
  its rows loses is found by its text, so such rows do not gather in one group.
* repeated rows: rows of one ``doc_id`` are one document for the counts; each
  row loses its lines alike.
* empty batch or table: the state stays as it is; no rows.
* extra columns: carried by ``drop_repeated``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import BLANKS, ascii_lower, ref, stage_table, text_of

MIN_CHARS = 20
MIN_DOCS = 3

# Shape of a filter: 4 cells a bucket, 16-bit fingerprints, filled to 3/4 at most.
CELLS = 4
LOAD = 0.75
MAX_KICKS = 500
KEYS_PER_SHARD = 5_000
DIGEST_BYTES = 16
_BLANK_BYTES = BLANKS.encode()

_COUNTS = "shard int, digest binary, n_docs long, last_doc long"
_POSTINGS = "shard int, digest binary, doc_id long"
_FILTERS = "shard int, cells binary"


class CuckooFilter:
    """Cuckoo filter over 64-bit hashes: 16-bit fingerprints, two buckets a key.

    The table doubles when it is too full or an insertion wanders too long; it
    is then built anew from the keys, which the exact counts hold.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.cells = np.zeros((buckets, CELLS), dtype=np.uint16)

    @staticmethod
    def sized_for(keys: int) -> "CuckooFilter":
        need = max(1, int(keys / (CELLS * LOAD)) + 1)
        return CuckooFilter(1 << (need - 1).bit_length())

    @staticmethod
    def from_bytes(data: bytes) -> "CuckooFilter":
        cells = np.frombuffer(data, dtype=np.uint16).reshape(-1, CELLS).copy()
        made = CuckooFilter(len(cells))
        made.cells = cells
        return made

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def _prints(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (hashes >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (hashes & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket, mark):
        """The partner bucket, found from either bucket and the fingerprint alone."""
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995) & (self.buckets - 1))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        mark, a, b = self._prints(hashes)
        return (self.cells[a] == mark[:, None]).any(axis=1) | (self.cells[b] == mark[:, None]).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Add keys; False when one found no cell, and the table must grow."""
        mark, a, b = self._prints(hashes)
        rows = [list(r) for r in self.cells.tolist()]
        dice = np.random.default_rng(len(rows) * 31 + len(hashes))
        done = True
        for m, x, y in zip(mark.tolist(), a.tolist(), b.tolist()):
            for at in (x, y):
                if 0 in rows[at]:
                    rows[at][rows[at].index(0)] = m
                    break
            else:
                at = y
                for slot in dice.integers(0, CELLS, MAX_KICKS).tolist():
                    m, rows[at][slot] = rows[at][slot], m
                    at = at ^ ((m * 0x5BD1E995) & (self.buckets - 1))
                    if 0 in rows[at]:
                        rows[at][rows[at].index(0)] = m
                        break
                else:
                    done = False
                    break
        self.cells = np.array(rows, dtype=np.uint16).reshape(-1, CELLS)
        return done

    def delete(self, hashes: np.ndarray) -> None:
        """Take out keys that were inserted."""
        mark, a, b = self._prints(hashes)
        for m, x, y in zip(mark.tolist(), a.tolist(), b.tolist()):
            for at in (x, y):
                hit = np.flatnonzero(self.cells[at] == m)
                if len(hit):
                    self.cells[at, hit[0]] = 0
                    break

    @staticmethod
    def build(hashes: np.ndarray) -> "CuckooFilter":
        made = CuckooFilter.sized_for(len(hashes))
        while not made.insert(hashes):
            made = CuckooFilter(made.buckets * 2)
        return made


@dataclass(frozen=True)
class LineState:
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


def empty_state(spark: SparkSession, shards: int) -> LineState:
    return LineState(
        spark.createDataFrame([], _POSTINGS), spark.createDataFrame([], _COUNTS), spark.createDataFrame([], _FILTERS), shards
    )


def shards_for(n_lines: int) -> int:
    """Shards so that a shard's filter holds about ``KEYS_PER_SHARD`` keys, however many lines there are."""
    return max(1, -(-n_lines // KEYS_PER_SHARD))


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _digest(key: Column) -> Column:
    """The first 128 bits of the key's SHA-256."""
    return F.unhex(F.substring(F.sha2(key.cast("binary"), 256), 1, 2 * DIGEST_BYTES))


def key_postings(docs: DataFrame, shards: int, min_chars: int = MIN_CHARS) -> DataFrame:
    """shard, digest, doc_id: the distinct keys of each document that are long enough."""
    keys = F.array_distinct(F.transform(F.split(text_of(), "\n"), line_key))
    long = F.filter(keys, lambda k: F.length(k) >= min_chars)
    return (
        docs.select(ref("doc_id").cast("long").alias("doc_id"), F.explode(long).alias("key"))
        .select(_digest(F.col("key")).alias("digest"), "doc_id")
        .distinct()
        .select(_shard(shards).alias("shard"), "digest", "doc_id")
    )


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _hashes(digests: pd.Series) -> np.ndarray:
    """64 bits of each digest; the digest is uniform, so any eight bytes serve."""
    return np.frombuffer(b"".join(d[:8] for d in digests), dtype=np.uint64)


def _ask_filters(counts: DataFrame, filters: DataFrame) -> DataFrame:
    """``counts`` with ``maybe``: may the key be among those already counted?"""

    def probe(keys: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if len(keys):
            known = (
                CuckooFilter.from_bytes(cells["cells"].iloc[0]).may_hold(_hashes(keys["digest"]))
                if len(cells)
                else np.zeros(len(keys), dtype=bool)
            )
        else:
            known = np.zeros(0, dtype=bool)
        return keys.assign(maybe=known)[["shard", "digest", "n_docs", "last_doc", "maybe"]].astype(
            {"last_doc": "Int64", "n_docs": "int64"}
        )

    return (
        counts.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(probe, _COUNTS + ", maybe boolean")
    )


def _update_filters(filters: DataFrame, counts: DataFrame, changed: DataFrame) -> DataFrame:
    """Filters after keys were added (``sign`` 1) or taken out (-1).

    Only the changed keys reach the filters; a shard whose filter is too full
    is built anew, of twice the size, from its keys in ``counts``.
    """

    def change(keys: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        shard = int((keys if len(keys) else cells)["shard"].iloc[0])
        added = _hashes(keys.loc[keys["sign"] > 0, "digest"])
        if not len(cells):
            return pd.DataFrame({"shard": [shard], "cells": [CuckooFilter.build(added).to_bytes()]})
        made = CuckooFilter.from_bytes(cells["cells"].iloc[0])
        made.delete(_hashes(keys.loc[keys["sign"] < 0, "digest"]))
        room = int((made.cells == 0).sum()) - made.cells.size * (1 - LOAD)
        fits = len(added) <= room and made.insert(added)
        return pd.DataFrame({"shard": [shard], "cells": [made.to_bytes() if fits else None]})

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.build(_hashes(keys["digest"]))
        return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "cells": [made.to_bytes()]})

    moved = stage_table(
        changed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(change, _FILTERS), "lines-moved"
    )
    full = moved.where(F.col("cells").isNull()).select(F.col("shard").alias("_shard"))
    anew = counts.select("shard", "digest").join(full, F.col("shard") == F.col("_shard"), "left_semi")
    return moved.where(F.col("cells").isNotNull()).unionByName(anew.groupBy("shard").applyInPandas(build, _FILTERS))


def _count(postings: DataFrame) -> DataFrame:
    return postings.groupBy("shard", "digest").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")
    )


def insert(state: LineState, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineState:
    """The state with the documents of a batch added; documents it already holds count once."""
    return insert_postings(state, stage_table(key_postings(docs, state.shards, min_chars), "lines-batch"))


def insert_postings(state: LineState, batch: DataFrame) -> LineState:
    """``insert`` from the distinct (shard, digest, doc_id) of a batch."""
    asked = stage_table(_ask_filters(_count(batch), state.filters), "lines-asked")
    maybe = asked.where("maybe").select(F.col("digest").alias("_digest"), F.lit(1).alias("_in_batch"))
    # Postings of maybe known keys that the state already holds count once.
    known = state.postings.join(maybe.select("_digest"), F.col("digest") == F.col("_digest"), "left_semi")
    fresh = stage_table(
        batch.join(
            known.select(F.col("digest").alias("_d"), F.col("doc_id").alias("_doc")),
            (F.col("digest") == F.col("_d")) & F.col("doc_id").eqNullSafe(F.col("_doc")),
            "left_anti",
        ),
        "lines-fresh",
    )
    stored = state.counts.join(maybe, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    untouched = stored.where(F.col("_in_batch").isNull()).drop("_in_batch")
    merged = (
        stored.where(F.col("_in_batch").isNotNull())
        .drop("_in_batch")
        .withColumn("old", F.lit(True))
        .unionByName(_count(fresh).withColumn("old", F.lit(False)))
        .groupBy("shard", "digest")
        .agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"), F.max("old").alias("old"))
    )
    merged = stage_table(merged, "lines-merged")
    counts = stage_table(untouched.unionByName(merged.drop("old")), "lines-counts")
    added = merged.where(~F.col("old")).select("shard", "digest", F.lit(1).alias("sign"))
    filters = stage_table(_update_filters(state.filters, counts, added), "lines-filters")
    return LineState(state.postings.unionByName(fresh), counts, filters, state.shards)


def delete(state: LineState, doc_ids: DataFrame) -> LineState:
    """The state without the documents of ``doc_ids`` (doc_id)."""
    gone_ids = doc_ids.select(ref("doc_id").cast("long").alias("_gone")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_gone"))
    gone = state.postings.join(gone_ids, same, "left_semi")
    postings = stage_table(state.postings.join(gone_ids, same, "left_anti"), "lines-postings")
    hit = stage_table(gone.select("digest").distinct().withColumnRenamed("digest", "_digest"), "lines-hit")
    recount = stage_table(
        _count(postings.join(hit, F.col("digest") == F.col("_digest"), "left_semi")), "lines-recount"
    )
    touched = state.counts.join(hit, F.col("digest") == F.col("_digest"), "left_semi")
    lost = touched.join(
        recount.select(F.col("digest").alias("_d")), F.col("digest") == F.col("_d"), "left_anti"
    ).select("shard", "digest", F.lit(-1).alias("sign"))
    kept = state.counts.join(hit, F.col("digest") == F.col("_digest"), "left_anti")
    counts = stage_table(kept.unionByName(recount), "lines-counts")
    filters = stage_table(_update_filters(state.filters, counts, lost), "lines-filters")
    return LineState(postings, counts, filters, state.shards)


def _hold(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    """Text without the lines whose key digest is in the drop list; null where there is none."""
    kept, gone = [], []
    for text, drop in zip(texts, drops):
        if text is None or drop is None:
            kept.append(None)
            gone.append(0)
            continue
        out = set(map(bytes, drop))
        lines = text.split(b"\n")
        stay = [x for x in lines if sha256(x.strip(_BLANK_BYTES).lower()).digest()[:DIGEST_BYTES] not in out]
        kept.append(b"\n".join(stay).decode("utf-8"))
        gone.append(len(lines) - len(stay))
    return pd.DataFrame({"text": pd.Series(kept, dtype=object), "n_dropped": gone})


def drop_repeated(docs: DataFrame, state: LineState, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc (struct of the columns of ``docs``), text, n_lines, n_dropped after dropping repeated lines.

    A key counted in ``min_docs`` documents or more loses all its lines except
    in the largest document holding it. Postings and counts meet in an equi-join
    on the digest, whose hot keys adaptive execution splits; a document gets the
    digests it must drop, and only documents with one pass through Python.
    """
    repeated = state.counts.where(F.col("n_docs") >= min_docs).select(F.col("digest").alias("_digest"), "last_doc")
    by_text = F.xxhash64(text_of())
    nameless = docs.where(ref("doc_id").isNull()).select(by_text.alias("doc_id"), text_of().alias("text"))
    held = state.postings.where(F.col("doc_id").isNotNull()).select("digest", "doc_id", F.lit(False).alias("_null"))
    held = held.unionByName(key_postings(nameless, 1, min_chars).select("digest", "doc_id", F.lit(True).alias("_null")))
    dropped = (
        held.join(repeated, F.col("digest") == F.col("_digest"))
        .where(F.col("_null") | ~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .groupBy(F.col("doc_id").alias("_doc"), "_null")
        .agg(F.collect_list("digest").alias("_drop"))
    )
    rows = docs.select(
        F.struct(*[ref(c) for c in docs.columns]).alias("doc"),
        F.coalesce(ref("doc_id").cast("long"), by_text).alias("_id"),
        ref("doc_id").isNull().alias("_nameless"),
        text_of().alias("_text"),
    )
    joined = rows.join(dropped, (F.col("_id") == F.col("_doc")) & (F.col("_nameless") == F.col("_null")), "left")
    touched = F.when(F.col("_drop").isNotNull(), F.col("_text").cast("binary"))
    hold = F.pandas_udf(_hold, "text string, n_dropped long")(touched, F.col("_drop"))
    return joined.withColumn("_held", hold).select(
        "doc",
        F.coalesce(F.col("_held.text"), F.col("_text")).alias("text"),
        F.size(F.split("_text", "\n")).cast("long").alias("n_lines"),
        F.col("_held.n_dropped").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = 2) -> DataFrame:
    """``drop_repeated`` of a whole table, its documents inserted in hash-dealt batches."""
    spark = docs.sparkSession
    one = stage_table(key_postings(docs, 1, min_chars), "lines-postings")
    shards = shards_for(one.count())
    postings = one.withColumn("shard", _shard(shards))
    state = empty_state(spark, shards)
    for k in range(batches):
        state = insert_postings(state, postings.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k))
    return drop_repeated(docs, state, min_chars, min_docs)


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the text after dropping repeated lines; ``n_chars``, where there is one, is counted anew."""
    held = dedup_lines(docs, min_chars, min_docs)
    anew = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return held.select(*[anew.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
