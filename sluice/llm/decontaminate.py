"""Benchmark decontamination over a distributed positional inverted index.

The test items are cut into windows of consecutive words. For every window its
rarest terms in the corpus are its anchors; the index stores the postings
(term, doc_id, positions) of the training tokens that are anchors. Posting
lists are shifted by the anchors' offsets and intersected: a document is a
candidate for a window when all anchors meet on one diagonal (document position
minus item position). Candidates are compared word for word, and every document
word inside an occurrence is marked.

Proximity matches are found beside them: anchors that meet within ``SLOP`` words
of their order make a candidate, and a window counts as near where at least
``NEAR_PERCENT`` of its words stand there in its order. A window whose anchors
themselves are changed is not found.

Scans know the test terms by a bitmap of fixed size (``SLOTS`` bits), whatever
the benchmark's size; an exact join on the term follows. Document counts of
terms are combined per batch before the shuffle, and the joins on term, item and
document are equi-joins whose hot keys adaptive execution splits.

Defined cases
-------------
* null or empty text: no words, no hit. An item without words has no window and
  never matches.
* null or repeated ``doc_id``: candidates belong to an id and text (by a hash of
  both), so rows with null ids do not gather in one group; each row is compared
  with its own text.
* null ``item_id``: counted as the item with the empty id; repeated ids count once.
* an item shorter than a window is one window of all its words.
* empty documents: no rows. Empty benchmark: nothing is hit.
* extra columns: carried in the struct ``doc``, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import ref, stage_table, text_of

WINDOW = 10
ANCHORS = 2
SLICE = 4 << 20  # bytes of text held as words at a time
SLOTS = 1 << 22  # bits of the term bitmap: half a megabyte, at most SLOTS integers reach the driver
_BITS = 63
SLOP = 3
NEAR_PERCENT = 80

# Bytes that part words (all ASCII but 0-9, A-Z, a-z), and the lower-casing of A-Z.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _slot(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) & (SLOTS - 1)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _terms_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([[w.decode("utf-8") for w in terms(t)] for t in texts])


@F.pandas_udf(T.IntegerType())
def _slot_udf(words: pd.Series) -> pd.Series:
    return pd.Series([_slot(w.encode("utf-8")) for w in words], dtype="int32")


def item_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """item (key), item_id, words, w (first word), term, j (offset): one row per word of each window."""
    items = bench.select(
        F.coalesce(ref("item_id").cast("string"), F.lit("")).alias("item_id"), text_of().alias("text")
    ).distinct()
    cut = items.select(
        F.xxhash64("item_id", "text").alias("item"), "item_id", _terms_udf(F.col("text").cast("binary")).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    return (
        cut.select("item", "item_id", "words", F.explode(starts).alias("w"))
        .select("item", "item_id", "words", "w", F.posexplode(F.slice("words", F.col("w") + 1, window)).alias("j", "term"))
    )


def term_bitmap(spark: SparkSession, words: DataFrame):
    """Broadcast bitmap of the terms' slots: ``SLOTS`` bits for any number of terms."""
    slots = words.select("term").distinct().select(_slot_udf("term").alias("slot")).distinct().toPandas()["slot"]
    bits = np.zeros(SLOTS, dtype=bool)
    bits[slots.to_numpy(dtype=np.int64)] = True
    return spark.sparkContext.broadcast(np.packbits(bits))


def _slices(texts: pd.Series) -> Iterator[slice]:
    """Runs of texts of about ``SLICE`` bytes, one text at least."""
    lo = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def _in_bitmap(packed: np.ndarray, candidates) -> set:
    """Those of the candidates whose slot is set."""
    found = list(candidates)
    if not found:
        return set()
    slots = np.array([_slot(w) for w in found], dtype=np.int64)
    hit = (packed[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1
    return {found[i] for i in np.flatnonzero(hit)}


def term_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """term, n: occurrences in the corpus of the terms of ``words``, combined per batch."""
    bitmap = term_bitmap(docs.sparkSession, words)

    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            for text in batch["text"]:
                seen.update(terms(text))
            known = _in_bitmap(bitmap.value, seen)
            found = pd.Series([w.decode("utf-8") for w in known], dtype=object)
            yield pd.DataFrame({"term": found, "n": pd.Series([seen[w] for w in known], dtype="int64")})

    counted = docs.select(text_of().cast("binary").alias("text")).mapInPandas(count, "term string, n long")
    asked = words.select(F.col("term").alias("_term")).distinct()
    return counted.groupBy("term").agg(F.sum("n").alias("n")).join(asked, F.col("term") == F.col("_term"), "left_semi")


def choose_anchors(windows: DataFrame, counts: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """item, w, term, p (item position): the rarest terms of each window that can occur at all."""
    known = windows.join(counts.withColumnRenamed("term", "_term"), F.col("term") == F.col("_term"), "left")
    whole = Window.partitionBy("item", "w")
    rarest = whole.orderBy("n", "j")
    return (
        known.withColumn("_missing", F.max(F.col("n").isNull()).over(whole))
        .where(~F.col("_missing"))
        .withColumn("_rank", F.row_number().over(rarest))
        .where(F.col("_rank") <= anchors)
        .select("item", "w", "term", (F.col("w") + F.col("j")).alias("p"))
    )


def row_key() -> Column:
    """What rows share that share their candidates: a hash of id and text. It may clash, as texts are compared at the end."""
    return F.xxhash64(ref("doc_id").cast("long"), text_of())


def build_index(docs: DataFrame, words: DataFrame) -> DataFrame:
    """term, doc_id, row (see ``row_key``), positions: postings of the training tokens whose term is in ``words``."""
    bitmap = term_bitmap(docs.sparkSession, words)

    def post(batches):
        for part in (batch.iloc[s] for batch in batches for s in _slices(batch["text"])):
            cut = [terms(t) for t in part["text"]]
            wanted = _in_bitmap(bitmap.value, set().union(*cut))
            out: list[tuple] = []
            for doc_id, row, tokens in zip(part["doc_id"], part["row"], cut):
                lists: dict[bytes, list[int]] = {}
                for at, w in enumerate(tokens):
                    if w in wanted:
                        lists.setdefault(w, []).append(at)
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                out.extend((w.decode("utf-8"), doc_id, row, at) for w, at in lists.items())
            made = pd.DataFrame(out, columns=["term", "doc_id", "row", "positions"], dtype=object)
            yield made.astype({"doc_id": "Int64", "row": "int64"})

    posted = docs.select(
        ref("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), text_of().cast("binary").alias("text")
    ).mapInPandas(post, "term string, doc_id long, row long, positions array<int>")
    asked = words.select(F.col("term").alias("_term")).distinct()
    return stage_table(posted.join(asked, F.col("term") == F.col("_term"), "left_semi"), "postings")


def shifted_postings(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, row, item, p, diagonal: each anchor's posting list shifted by its place in the item."""
    places = anchors.select(F.col("term").alias("_term"), "item", "p").distinct()
    return index.join(places, F.col("term") == F.col("_term")).select(
        "doc_id", "row", "item", "p", F.explode(F.transform("positions", lambda x: x - F.col("p"))).alias("diagonal")
    )


def phrase_candidates(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, row, item, diagonal, ws: windows all of whose anchors meet on the diagonal."""

    def bit(p: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (p % _BITS).cast("int"))

    # Anchors met are bits, so the intersection is one hash aggregate of numbers; items longer than
    # _BITS words share bits, which can only let through a window that the comparison then refuses.
    met = shifted_postings(index, anchors).groupBy("row", "item", "diagonal").agg(F.first("doc_id").alias("doc_id"), F.bit_or(bit(F.col("p"))).alias("met"))
    windows = (
        anchors.groupBy("item", "w")
        .agg(F.bit_or(bit(F.col("p"))).alias("need"))
        .groupBy("item")
        .agg(F.collect_list(F.struct("w", "need")).alias("windows"))
        .withColumnRenamed("item", "_item")
    )

    def is_met(x: Column) -> Column:
        return F.col("met").bitwiseAND(x.getField("need")) == x.getField("need")

    return (
        met.join(windows, F.col("item") == F.col("_item"))
        .where(F.exists("windows", is_met))
        .select(
            "doc_id", "row", "item", "diagonal", F.transform(F.filter("windows", is_met), lambda x: x.getField("w")).alias("ws")
        )
    )


def proximity_matches(index: DataFrame, anchors: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc_id, row, item, w, start, spread: all anchors of the window meet within ``slop`` words of their order."""
    posts = shifted_postings(index, anchors)
    wanted = anchors.select(F.col("item").alias("_item"), "w", F.col("p").alias("_p"))
    sizes = Window.partitionBy("_item", "w")
    rows = posts.join(
        wanted.withColumn("_n", F.count(F.lit(1)).over(sizes)), (F.col("item") == F.col("_item")) & (F.col("p") == F.col("_p"))
    )
    near = Window.partitionBy("row", "item", "w").orderBy("diagonal").rangeBetween(0, slop)
    return (
        rows.select(
            "doc_id",
            "row",
            "item",
            "w",
            "_n",
            (F.col("diagonal") + F.col("w")).alias("start"),
            F.size(F.collect_set("p").over(near)).alias("_met"),
            (F.max("diagonal").over(near) - F.col("diagonal")).alias("spread"),
        )
        .where(F.col("_met") == F.col("_n"))
        .select("doc_id", "row", "item", "w", "start", "spread")
        .distinct()
    )


def in_order(phrase: list, tokens: list) -> int:
    """The most words of ``phrase`` that stand in ``tokens`` in its order."""
    best = [0] * (len(tokens) + 1)
    for w in phrase:
        before = 0
        for i, t in enumerate(tokens, 1):
            kept = best[i]
            best[i] = before + 1 if t == w else max(best[i], best[i - 1])
            before = kept
    return best[-1]


def _mark(window: int, slop: int):
    def of(texts: pd.Series, found: pd.Series, close: pd.Series) -> pd.DataFrame:
        n_words, n_hit, items, near = [], [], [], []
        for text, exact, around in zip(texts, found, close):
            tokens = terms(text)
            n_words.append(len(tokens))
            hit = np.zeros(len(tokens), dtype=bool) if exact is not None and len(exact) else None
            ids, near_ids = set(), set()
            for c in exact if hit is not None else ():
                words = [w.encode("utf-8") for w in c["words"]]
                for w in c["ws"]:
                    at = c["diagonal"] + w
                    phrase = words[w : w + window]
                    if at >= 0 and tokens[at : at + len(phrase)] == phrase:
                        hit[at : at + len(phrase)] = True
                        ids.add(c["item_id"])
            for c in around if around is not None else ():
                if c["item_id"] in ids or c["item_id"] in near_ids:
                    continue
                phrase = [w.encode("utf-8") for w in c["words"][c["w"] : c["w"] + window]]
                at = max(0, c["start"] - slop)
                if 100 * in_order(phrase, tokens[at : c["start"] + len(phrase) + slop]) >= NEAR_PERCENT * len(phrase):
                    near_ids.add(c["item_id"])
            n_hit.append(0 if hit is None else int(hit.sum()))
            items.append(sorted(ids))
            near.append(sorted(near_ids - ids))
        return pd.DataFrame({"n_words": n_words, "n_hit": n_hit, "items": items, "near_items": near})

    return F.pandas_udf(of, "n_words long, n_hit long, items array<string>, near_items array<string>")


def mark_contaminated(
    docs: DataFrame, bench: DataFrame, window: int = WINDOW, anchors: int = ANCHORS, slop: int | None = None
) -> DataFrame:
    """doc (struct of the columns of ``docs``), n_words, n_hit, items, near_items.

    ``items``: sorted ids of the items with occurring windows; ``near_items``:
    those of the other items with a window near its order, where ``slop`` is given.
    """
    windows = stage_table(item_windows(bench, window), "bench-windows")
    words = windows.select("term")
    chosen = stage_table(choose_anchors(windows, term_counts(docs, words), anchors), "bench-anchors")
    index = build_index(docs, chosen.select("term"))
    texts = windows.select(F.col("item").alias("_item"), "item_id", "words").distinct()

    def per_row(candidates: DataFrame, *columns: str) -> DataFrame:
        return (
            candidates.join(texts, F.col("item") == F.col("_item"))
            .groupBy("row")
            .agg(F.collect_list(F.struct("item_id", "words", *columns)).alias("_list"))
        )

    exact = per_row(phrase_candidates(index, chosen), "diagonal", "ws").select(
        F.col("row").alias("_row"), F.col("_list").alias("_found")
    )
    if slop is None:
        met = exact.withColumn("_near", F.lit(None).cast("array<struct<item_id:string,words:array<string>,w:int,start:int>>"))
    else:
        near = per_row(proximity_matches(index, chosen, slop), "w", "start").select(
            F.col("row").alias("_near_row"), F.col("_list").alias("_near")
        )
        met = exact.join(near, F.col("_row") == F.col("_near_row"), "full").select(
            F.coalesce("_row", "_near_row").alias("_row"), "_found", "_near"
        )
    rows = docs.select(
        F.struct(*[ref(c) for c in docs.columns]).alias("doc"),
        row_key().alias("_id"),
        text_of().cast("binary").alias("_text"),
    )
    return (
        rows.join(met, F.col("_id") == F.col("_row"), "left")
        .withColumn("_m", _mark(window, slop or 0)(F.col("_text"), F.col("_found"), F.col("_near")))
        .select("doc", "_m.n_words", "_m.n_hit", "_m.items", "_m.near_items")
    )


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a window of a benchmark item."""
    return mark_contaminated(docs, bench).where(F.col("n_hit") == 0).select("doc.*")
