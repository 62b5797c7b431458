"""Phrase collocation mining by SETM: occurrence relations, merge-joined and counted level by level.

The occurrence relation of level k holds, sorted by piece and position, where
which frequent phrase of k words stands. It is a table in the shared folder, in
blocks of bounded size: a row per block with one entry per position, zero where
no frequent phrase begins and between two pieces. A level does what SETM does:

1. merge-join: two entries at adjacent positions of a piece make a longer
   phrase, the pair of their ids;
2. group-count: each block counts its own pairs, parts them by hash into shards
   and the shards are summed, sorted as packed arrays. A pair comes once from
   each block, so a frequent one is no hot key;
3. semi-join: a shard tells each block which of its pairs are frequent and their
   new ids; the block keeps these occurrences as the relation of the next level.

Ids are given by the shards, so phrases are compared exactly and never by hash.
Shards are sized by the pairs there are, so none outgrows a task. What is left
are tables of frequent phrases; cuts, scores and absorption are joins of these.

Everything is per language; a null language is ``und``. A null or empty text
has no words. Repeated rows count each. An empty table gives no rows. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import drop_stage, ref, small_batches, stage_table, text_of
from sluice.llm.packing import pack, pack_sorted, rows_of, squeeze, unpack, unpack_sorted, unsqueeze

# What parts pieces, and the least occurrences, lengths and thresholds of a candidate.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
ABSORBED_PERCENT = 80
SCALE = 2_000_000

BLOCK_BYTES = 16 << 20  # text in a block
SHARD_ENTRIES = 1 << 19  # entries of a shard of a count, some 100 MB of words or 60 MB of pairs while it is summed

_TABLE = bytes(0x0A if c in PIECE_ENDS else 0x20 if c == 0x09 else c for c in range(256))
_BREAK = b"\n"


class _Vocabulary(dict):
    """Numbers words in the order they come; a break between pieces is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


_BLOCKS = "lang string, block long, n_words long, n_entries long, words binary, counts binary, occ binary"


def _blocks(block_bytes: int):
    schema = pa.schema(
        [("lang", pa.string()), ("block", pa.int64()), ("n_words", pa.int64()), ("n_entries", pa.int64())]
        + [(c, pa.binary()) for c in ("words", "counts", "occ")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: dict[str, tuple[_Vocabulary, array]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block
            for lang, (vocabulary, occurrences) in held.items():
                occ = np.frombuffer(occurrences, np.int32)
                counts = np.bincount(occ, minlength=len(vocabulary))[1:].astype(np.int64)
                words = list(vocabulary)[1:]
                row = [lang, block, int(counts.sum()), len(words), squeeze(b"\n".join(words)), pack(counts), pack(occ)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)
                block += 1
            held.clear()

        for batch in batches:
            for lang, raw in rows_of(batch, "lang", "text"):
                if lang not in held:
                    held[lang] = (_Vocabulary({_BREAK: 0}), array("i"))
                vocabulary, occurrences = held[lang]
                tokens = raw.lower().translate(_TABLE).replace(_BREAK, b" \n ").split(b" ")
                occurrences.extend(map(vocabulary.__getitem__, filter(None, tokens)))
                occurrences.append(0)
                size += len(raw)
                if size >= block_bytes:
                    yield from flush()
                    size = 0
        yield from flush()

    return cut


# A shard's answer: rows of groups (block null) and, per block, the entries that are frequent with their ids.
_COUNTED = "block long, entries binary, ids binary, id long, a long, b long, f long, lang string, word binary"
_COUNTED_TYPES = [
    ("block", pa.int64()),
    ("entries", pa.binary()),
    ("ids", pa.binary()),
    ("id", pa.int64()),
    ("a", pa.int64()),
    ("b", pa.int64()),
    ("f", pa.int64()),
    ("lang", pa.string()),
    ("word", pa.binary()),
]


def _answer(groups: dict, hits: list[tuple[int, bytes, bytes]]) -> pa.Table:
    n = len(groups["id"])
    columns = []
    for name, kind in _COUNTED_TYPES:
        if name in ("block", "entries", "ids"):
            at = ("block", "entries", "ids").index(name)
            columns.append(pa.array([None] * n + [h[at] for h in hits], kind))
        else:
            columns.append(pa.array([*groups.get(name, [None] * n), *[None] * len(hits)], kind))
    return pa.Table.from_arrays(columns, schema=pa.schema(_COUNTED_TYPES))


def _shard_rows(shard: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The entries of each shard; the order inside a shard is kept."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else []
    ends = np.r_[starts[1:], len(shard)] if len(shard) else []
    dealt = {name: values[order] for name, values in columns.items()}
    for start, end in zip(starts, ends):
        yield int(shard[start]), {name: values[start:end] for name, values in dealt.items()}


# -- level 1: words ----------------------------------------------------------

_WORD_SHARDS = "shard int, block long, lang string, words binary, entries binary, counts binary"


def _word_shards(shards: int):
    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int64()), ("lang", pa.string())]
        + [(c, pa.binary()) for c in ("words", "entries", "counts")]
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        for batch in batches:
            for block, lang, words, counts in rows_of(batch, "block", "lang", "words", "counts"):
                n = unpack(counts).astype(np.int64)
                if not len(n):
                    continue
                cut = unsqueeze(words).split(_BREAK)
                shard = np.fromiter(map(crc32, cut), np.int64, len(cut)) % shards
                rows = {"shard": [], "block": [], "lang": [], "words": [], "entries": [], "counts": []}
                entry = np.arange(1, len(cut) + 1)
                for s, packed in _shard_rows(shard, {"entries": entry, "counts": n}):
                    rows["shard"].append(s)
                    rows["block"].append(block)
                    rows["lang"].append(lang)
                    rows["words"].append(squeeze(b"\n".join([cut[i - 1] for i in packed["entries"].tolist()])))
                    rows["entries"].append(pack_sorted(packed["entries"]))
                    rows["counts"].append(pack(packed["counts"]))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), schema.types)], schema=schema)

    return deal


def _count_words(min_count: int):
    def count(shard: pa.Table) -> pa.Table:
        rows = sorted(
            zip(*(shard.column(c).to_pylist() for c in ("lang", "block", "words", "entries", "counts"))), key=lambda r: r[:2]
        )
        first = shard.column("shard")[0].as_py() << 32
        totals: dict[tuple[str, bytes], int] = {}
        for lang, _block, words, _entries, counts in rows:
            for word, n in zip(unsqueeze(words).split(_BREAK), unpack(counts).tolist()):
                totals[lang, word] = totals.get((lang, word), 0) + n
        kept = sorted(key for key, n in totals.items() if n >= min_count)
        ids = {key: first + i for i, key in enumerate(kept)}
        hits = []
        for lang, block, words, entries, _counts in rows:
            found = [ids.get((lang, word), -1) for word in unsqueeze(words).split(_BREAK)]
            found = np.array(found, np.int64)
            frequent = found >= 0
            if frequent.any():
                hits.append((block, pack_sorted(unpack_sorted(entries)[frequent]), pack(found[frequent])))
        groups = {
            "id": list(ids.values()),
            "f": [totals[k] for k in kept],
            "lang": [k[0] for k in kept],
            "word": [k[1] for k in kept],
        }
        return _answer(groups, hits)

    return count


# -- level k + 1: pairs of adjacent entries of level k -----------------------

_RELATION = "block long, n_entries long, ids binary, occ binary"
_RELATION_TYPES = [("block", pa.int64()), ("n_entries", pa.int64()), ("ids", pa.binary()), ("occ", pa.binary())]
_PAIR_SHARDS = "shard int, block long, entries binary, counts binary, a binary, b binary"


def _adjacent(occ: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge-join of a relation with itself shifted by one: positions and pair numbers of adjacent entries."""
    at = np.flatnonzero((occ[:-1] > 0) & (occ[1:] > 0))
    return at, occ[at].astype(np.int64) * (size + 1) + occ[at + 1]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two ids, to deal pairs over shards."""
    with np.errstate(over="ignore"):
        h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) + np.uint64(0x7F4A7C15))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _pair_shards(shards: int):
    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("entries", "counts", "a", "b")]
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, occ in rows_of(batch, "block", "ids", "occ"):
                ids = unpack(ids).astype(np.int64)
                _at, pairs = _adjacent(unpack(occ).astype(np.int64), len(ids))
                if not len(pairs):
                    continue
                entry, n = np.unique(pairs, return_counts=True)
                a, b = ids[entry // (len(ids) + 1) - 1], ids[entry % (len(ids) + 1) - 1]
                shard = (_mix(a, b) % np.uint64(shards)).astype(np.int64)
                rows = {c: [] for c in schema.names}
                for s, packed in _shard_rows(shard, {"entries": entry, "counts": n.astype(np.int64), "a": a, "b": b}):
                    rows["shard"].append(s)
                    rows["block"].append(block)
                    rows["entries"].append(pack_sorted(packed["entries"]))
                    for name in ("counts", "a", "b"):
                        rows[name].append(pack(packed[name]))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), schema.types)], schema=schema)

    return deal


def _count_pairs(min_count: int):
    def count(shard: pa.Table) -> pa.Table:
        blocks = shard.column("block").to_pylist()
        packed = {c: [unpack(x).astype(np.int64) for x in shard.column(c).to_pylist()] for c in ("counts", "a", "b")}
        packed["entries"] = [unpack_sorted(x) for x in shard.column("entries").to_pylist()]
        first = shard.column("shard")[0].as_py() << 32
        a, b, n = (np.concatenate(packed[c]) for c in ("a", "b", "counts"))
        order = np.lexsort((b, a))
        sa, sb = a[order], b[order]
        new = np.r_[True, (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])]
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(n[order], starts)
        frequent = totals >= min_count
        ids = np.where(frequent, first + np.cumsum(frequent) - 1, -1)
        of_entry = np.empty(len(a), np.int64)
        of_entry[order] = ids[np.cumsum(new) - 1]
        hits, end = [], 0
        for block, entries in zip(blocks, packed["entries"]):
            start, end = end, end + len(entries)
            own = of_entry[start:end]
            if (own >= 0).any():
                hits.append((block, pack_sorted(entries[own >= 0]), pack(own[own >= 0])))
        groups = {"id": ids[frequent], "a": sa[starts][frequent], "b": sb[starts][frequent], "f": totals[frequent]}
        return _answer({k: v.tolist() for k, v in groups.items()}, hits)

    return count


def _keep(words: bool):
    """Semi-join of a block with the frequent entries that the shards found in it."""

    def keep(block: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        if block.num_rows and found.num_rows:
            entries = np.concatenate([unpack_sorted(x) for x in found.column("entries").to_pylist()]).astype(np.int64)
            ids = np.concatenate([unpack(x) for x in found.column("ids").to_pylist()])
            order = np.argsort(entries)
            entries, ids = entries[order], ids[order]
            occ = unpack(block.column("occ")[0].as_py()).astype(np.int64)
            at, now = (
                (np.flatnonzero(occ), occ[occ > 0])
                if words
                else _adjacent(occ, len(unpack(block.column("ids")[0].as_py())))
            )
            place = np.minimum(np.searchsorted(entries, now), len(entries) - 1)
            met = entries[place] == now
            kept = np.zeros(len(occ), np.int32)
            kept[at[met]] = place[met] + 1
            pairs = int(((kept[:-1] > 0) & (kept[1:] > 0)).sum())
            rows.append((block.column("block")[0].as_py(), pairs, pack(ids), pack(kept)))
        return pa.Table.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, (_n, t) in enumerate(_RELATION_TYPES)], schema=pa.schema(_RELATION_TYPES)
        )

    return keep


# -- the levels --------------------------------------------------------------


def _shards_for(relation: DataFrame, shard_entries: int) -> int:
    entries = relation.agg(F.sum("n_entries").alias("n")).first()["n"] or 0
    return max(1, -(-entries // shard_entries))


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    block_bytes: int = BLOCK_BYTES,
    shard_entries: int = SHARD_ENTRIES,
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of every phrase of up to ``max_words`` words with ``min_count`` occurrences; (lang, n) words in all."""
    small_batches(docs.sparkSession)
    relation = stage_table(
        docs.select(
            F.coalesce(ref("lang").cast("string"), F.lit("und")).alias("lang"), text_of().cast("binary").alias("text")
        ).mapInArrow(_blocks(block_bytes), _BLOCKS),
        "setm-1",
    )
    sizes = stage_table(relation.groupBy("lang").agg(F.sum("n_words").alias("n")), "setm-sizes")
    levels: list[DataFrame] = []
    for k in range(1, max_words + 1):
        shards = _shards_for(relation, shard_entries)
        if k == 1:
            dealt = relation.select("block", "lang", "words", "counts").mapInArrow(_word_shards(shards), _WORD_SHARDS)
            counted = dealt.groupBy("shard").applyInArrow(_count_words(min_count), _COUNTED)
        else:
            dealt = relation.select("block", "ids", "occ").mapInArrow(_pair_shards(shards), _PAIR_SHARDS)
            counted = dealt.groupBy("shard").applyInArrow(_count_pairs(min_count), _COUNTED)
        counted = stage_table(counted, f"setm-counts-{k}")
        groups = counted.where(F.col("block").isNull())
        if k == 1:
            level = groups.select("id", "lang", F.array(F.col("word").cast("string")).alias("words"), "f")
        else:
            before = levels[-1]
            head = before.select(F.col("id").alias("a"), "lang", F.col("words").alias("head"))
            tail = before.select(F.col("id").alias("b"), F.element_at("words", -1).alias("tail"))
            level = groups.select("id", "a", "b", "f").join(head, "a").join(tail, "b").select(
                "id", "lang", F.concat("head", F.array("tail")).alias("words"), "f"
            )
        levels.append(stage_table(level, f"setm-phrases-{k}"))
        if k == max_words:
            drop_stage(relation, counted)
            break
        found = counted.where(F.col("block").isNotNull()).select("block", "entries", "ids")
        held = relation.select("block", "occ") if k == 1 else relation.select("block", "ids", "occ")
        longer = stage_table(
            held.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_keep(k == 1), _RELATION), f"setm-{k + 1}"
        )
        drop_stage(relation, counted)
        relation = longer
    return reduce(DataFrame.unionByName, [x.select("lang", "words", "f") for x in levels]), sizes


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def _exact(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(19,0)")


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    absorbed_percent: int = ABSORBED_PERCENT,
    block_bytes: int = BLOCK_BYTES,
    shard_entries: int = SHARD_ENTRIES,
) -> DataFrame:
    """lang, rank, phrase, words, a, l, r, n, score: the ``top`` collocations of each language.

    ``a`` occurrences of the phrase, ``l`` and ``r`` those of the two parts of
    its weakest cut, score ``2000000 a / (l + r)`` rounded down. A phrase inside
    a longer candidate that makes up ``absorbed_percent`` of its occurrences is
    left out. Products are decimals, exact beyond 64 bits.
    """
    phrases, sizes = frequent_phrases(docs, min_count, max_words, block_bytes, shard_entries)
    known = phrases.select(F.col("lang").alias("_lang"), _phrase("words").alias("_part"), F.col("f").alias("_f"))
    candidates = phrases.where(F.size("words") >= 2).select("lang", "words", _phrase("words").alias("phrase"), F.col("f").alias("a"))

    size = F.size("words")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        _phrase(F.slice("words", F.lit(1), F.col("k"))).alias("left"),
        _phrase(F.slice("words", F.col("k") + 1, size)).alias("right"),
    )
    for part, count in (("left", "l"), ("right", "r")):
        named = known.select("_lang", "_part", F.col("_f").alias(count))
        cuts = cuts.join(named, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).drop("_lang", "_part")
    score = F.expr(f"(cast(a as decimal(19,0)) * {SCALE}BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = (
        cuts.withColumn("score", score.cast("long"))
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("words").alias("words"))
    )

    # Phrases of two words and more inside longer candidates, with the most occurrences of such a candidate.
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: _phrase(F.slice("words", i, n))),
        )
    )
    inside = (
        candidates.where(size >= 3)
        .select("lang", "a", F.explode(F.array_distinct(spans)).alias("inner"))
        .groupBy(F.col("lang").alias("_lang"), "inner")
        .agg(F.max("a").alias("longer"))
    )
    absorbed = F.coalesce(_exact("longer") * 100 >= _exact("a") * absorbed_percent, F.lit(False))
    kept = scored.join(inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("inner")), "left").where(~absorbed)
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(sizes.withColumnRenamed("lang", "_of"), F.col("lang") == F.col("_of")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score"
    )
