"""LM scoring: a gated recurrent language model trained and applied by Spark tasks.

1. Every training word is counted (combined per task, ``HELD_WORDS`` at a time, then summed by word).
2. The ``LEADING * MEMBERS`` commonest tokens get output weights of their own;
   all others fall into trailing classes by their first two bytes, and are
   parted within the class by their discounted counts, with the freed mass for
   words never seen. The model is a distribution over all known words and one
   unknown word per trailing class, given all tokens before.
3. Training goes in rounds over growing, disjoint parts of all training texts.
   In a round each task trains a copy of the model on its texts (see ``gru``);
   the copies are averaged, weighted by their tokens, by a tree of groups.
4. Scoring runs each whole text through the model, its state carried to the
   end. Both read the texts as token ids, which one pass writes to a stage
   table. Words beyond the broadcast head of the vocabulary (at most ``HEAD``
   words) get their counts by a join on the word; they are rare by definition,
   so no key of that join is hot.

What is counted and trained on grows with the corpus; what reaches the driver
(the head, two-byte statistics, one set of weights) does not.

Defined cases
-------------
* null or empty text: only the end token. null ``doc_id``: the empty id, held out.
* no training texts: every word is unknown; base and model scores are finite.
* repeated rows: one result row each, and each is learnt from.
* ties in the counts: ordered by the word. Empty table: no rows.
* extra columns are not read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import gru
from sluice.llm.common import ref, stage_table, text_of
from sluice.llm.labelled import fold

FOLDS = 10
LEADING = 16
TRAILING = 48
HEAD = 200_000
ROUNDS = ((0, 1), (1, 2), (2, 4), (4, 8), (8, 16))  # sixteenths of the training texts
TOKENS_PER_COPY = 1_000_000
FAN = 16  # copies averaged in one group
END = b""
HELD_TOKENS = 4_000_000  # tokens a task packs into lanes at a time
HELD_WORDS = 200_000  # different words a task counts before it sends them on

_HEAD_BUCKETS = 16  # steps of the count scale per doubling, for the cut of the head


def tokens(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def task_counts(train: DataFrame) -> DataFrame:
    """word, n as each task counts them."""

    def made(seen: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(tokens(text.as_py()))
            if batch.num_rows:
                seen[END] += batch.num_rows
            if len(seen) >= HELD_WORDS:
                yield made(seen)
                seen = Counter()
        if seen:
            yield made(seen)

    return train.select(text_of().cast("binary").alias("text")).mapInArrow(count, "word binary, n long")


def count_words(train: DataFrame) -> DataFrame:
    """word, n over all training texts; the end token is the empty word."""
    return stage_table(task_counts(train).groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


@dataclass
class Vocabulary:
    total: int  # training tokens
    types: int  # different training tokens
    words: dict  # head word -> row of the arrays below
    counts: np.ndarray
    ids: np.ndarray  # input id
    classes: np.ndarray
    members: np.ndarray  # place in a leading class, else -1
    fixed: np.ndarray  # log10 of the word's share of a trailing class, else 0
    prefixes: dict  # two bytes -> trailing class
    size: np.ndarray  # per class: tokens
    discount: np.ndarray  # per class, taken off every count
    unknown: np.ndarray  # per class: share of words never seen

    @property
    def shape(self) -> gru.Shape:
        return gru.Shape(LEADING * gru.MEMBERS + TRAILING + 1, LEADING, LEADING + TRAILING)

    @property
    def start(self) -> int:
        return self.shape.inputs - 1

    def trailing(self, word: bytes) -> int:
        return self.prefixes.get(word[:2], LEADING + TRAILING - 1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.types + 1)))

    def sequence(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Head rows (-1 beyond it) and classes of the words and the end token."""
        trailing = self.trailing
        rows = np.fromiter(map(self.words.get, chain(words, (END,)), repeat(-1)), np.int64, len(words) + 1)
        classes = self.classes[rows].astype(np.int32) if len(self.classes) else np.zeros(len(rows), np.int32)
        beyond = np.flatnonzero(rows < 0)
        classes[beyond] = [trailing(words[i]) if i < len(words) else LEADING + TRAILING - 1 for i in beyond.tolist()]
        return rows, classes

    def encoded(self, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Token ids for the network."""
        ids = LEADING * gru.MEMBERS + classes - LEADING
        known = rows >= 0
        ids[known] = self.ids[rows[known]]
        return ids.astype(np.int16)

    def first_weights(self) -> np.ndarray:
        member = np.full((LEADING, gru.MEMBERS), 0.1)
        lead = self.members >= 0
        member[self.classes[lead], self.members[lead]] += self.counts[lead]
        size = self.size + 1.0
        return gru.first_weights(
            self.shape, np.log(size / size.sum()), np.log(member / member.sum(axis=1, keepdims=True))
        )


def build_vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """The bounded part of the vocabulary that reaches the driver."""
    whole = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, types = int(whole["n"] or 0), int(whole["v"])
    level = F.floor(F.log2("n") * _HEAD_BUCKETS)
    cut, held = 0, 0
    for row in sorted(counts.groupBy(level.alias("l")).count().collect(), key=lambda r: -r["l"]):
        if held + row["count"] > head:
            cut = row["l"] + 1
            break
        held += row["count"]
    common = counts.where(level >= cut).toPandas() if types else pd.DataFrame({"word": [], "n": []})
    common = sorted(zip(map(bytes, common["word"]), map(int, common["n"])), key=lambda x: (-x[1], x[0]))
    common.sort(key=lambda x: x[0] != END)  # the end token always leads
    once, twice = F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long"))
    by_prefix = {
        bytes(r["p"]): np.array([r["n"], r["v"], r["n1"], r["n2"]], dtype=float)
        for r in counts.groupBy(F.substring("word", 1, 2).alias("p"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), once.alias("n1"), twice.alias("n2"))
        .collect()
    }
    n_lead = LEADING * gru.MEMBERS
    for w, n in common[:n_lead]:
        by_prefix[w[:2]] -= [n, 1, n == 1, n == 2]
    ranked = sorted(by_prefix, key=lambda p: (-by_prefix[p][0], p))
    prefixes = {p: LEADING + i for i, p in enumerate(ranked[: TRAILING - 1])}
    stats = np.zeros((LEADING + TRAILING, 4))
    for p, s in by_prefix.items():
        stats[prefixes.get(p, LEADING + TRAILING - 1)] += s
    for i, (_, n) in enumerate(common[:n_lead]):
        stats[i // gru.MEMBERS, 0] += n
    size, kinds, n1, n2 = stats.T
    discount = np.where(n1 + n2 > 0, n1 / np.maximum(1, n1 + 2 * n2), 0.5).clip(0.1, 0.9)
    unknown = np.where(size > 0, discount * np.maximum(kinds, 0.5) / np.maximum(1, size), 1.0)
    ids, classes, members, fixed = [], [], [], []
    for i, (w, n) in enumerate(common):
        if i < n_lead:
            ids.append(i)
            classes.append(i // gru.MEMBERS)
            members.append(i % gru.MEMBERS)
            fixed.append(0.0)
        else:
            c = prefixes.get(w[:2], LEADING + TRAILING - 1)
            ids.append(n_lead + c - LEADING)
            classes.append(c)
            members.append(-1)
            fixed.append(float(np.log10((n - discount[c]) / size[c])))
    return Vocabulary(
        total,
        types,
        {w: i for i, (w, _) in enumerate(common)},
        np.array([n for _, n in common], dtype=float),
        np.array(ids, np.int32),
        np.array(classes, np.int16),
        np.array(members, np.int16),
        np.array(fixed),
        prefixes,
        size,
        discount,
        unknown,
    )


def _packs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches put together until they hold about ``HELD_TOKENS`` tokens: full lanes, bounded memory."""
    held, size = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += int(batch["ids"].map(len).sum()) // 2
        if size >= HELD_TOKENS:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _lanes(pack: pd.DataFrame, shape: gru.Shape) -> gru.Lanes:
    return gru.pack([np.frombuffer(ids, np.int16) for ids in pack["ids"]], shape.inputs - 1)


def _train_copies(part: DataFrame, shape: gru.Shape, weights: np.ndarray, squares: np.ndarray) -> DataFrame:
    """copy, tokens, weights, squares: one trained copy per task."""
    state = part.sparkSession.sparkContext.broadcast((weights, squares))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flat, sums = state.value[0].copy(), state.value[1].copy()
        model, seen = gru.Model(shape, flat), 0
        for pack in _packs(batches):
            lanes = _lanes(pack, shape)
            seen += int(lanes.length.sum())
            model.train(lanes, sums)
        if seen:
            yield pd.DataFrame(
                {
                    "copy": [TaskContext.get().partitionId()],
                    "tokens": [float(seen)],
                    "weights": [flat.tobytes()],
                    "squares": [sums.tobytes()],
                }
            )

    return part.select("ids").mapInPandas(learn, _COPY)


_COPY = "copy long, tokens double, weights binary, squares binary"


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    share = rows["tokens"].to_numpy() / rows["tokens"].sum()

    def mean(name: str) -> bytes:
        total = sum(np.frombuffer(v, np.float32) * np.float32(s) for v, s in zip(rows[name], share))
        return total.tobytes()

    return pd.DataFrame(
        {
            "copy": [int(rows["copy"].iloc[0]) // FAN],
            "tokens": [rows["tokens"].sum()],
            "weights": [mean("weights")],
            "squares": [mean("squares")],
        }
    )


def train(encoded: DataFrame, vocabulary: Vocabulary, rounds=ROUNDS) -> np.ndarray:
    """Weights after all rounds over the training texts of ``encoded`` (part, ids)."""
    weights = vocabulary.first_weights()
    squares = np.zeros_like(weights)
    for lo, hi in rounds:
        copies = max(1, round(vocabulary.total * (hi - lo) / 16 / TOKENS_PER_COPY))
        texts = encoded.where((F.col("part") >= lo) & (F.col("part") < hi)).coalesce(copies)
        trained = stage_table(_train_copies(texts, vocabulary.shape, weights, squares), "lm-copies")
        while (trained.agg(F.max("copy")).first()[0] or 0) > 0:
            trained = stage_table(
                trained.groupBy(F.floor(F.col("copy") / FAN)).applyInPandas(_mean, _COPY), "lm-copies"
            )
        for row in trained.take(1):
            weights = np.frombuffer(row["weights"], np.float32).copy()
            squares = np.frombuffer(row["squares"], np.float32).copy()
    return weights


_ENCODED = (
    "row long, doc_id long, part int, n_tokens long, n_known long, base double, fixed double, "
    "ids binary, rest array<binary>, rest_class array<short>"
)


def _encode(docs: DataFrame, known, folds: int) -> DataFrame:
    """Every text as token ids, with the sums that the head of the vocabulary settles and the words beyond it.

    ``part`` deals the training texts to sixteen parts; held-out texts are in part -1.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = pickle.loads(known.value)
        base = vocabulary.base(vocabulary.counts)
        for batch in batches:
            ids, n_known, base_sum, fixed, rest, rest_class, sizes = [], [], [], [], [], [], [0]
            for text in batch.column("text"):
                words = tokens(text.as_py())
                rows, classes = vocabulary.sequence(words)
                head = rows[rows >= 0]
                n_known.append(len(head))
                base_sum.append(float(base[head].sum()))
                fixed.append(float(vocabulary.fixed[head].sum()))
                beyond = np.flatnonzero(rows < 0)
                rest.extend(words[i] if i < len(words) else END for i in beyond.tolist())
                rest_class.append(classes[beyond])
                sizes.append(len(beyond))
                ids.append(vocabulary.encoded(rows, classes).tobytes())
            if not ids:
                continue
            edges = pa.array(np.cumsum(sizes).astype(np.int32))
            columns = {
                "row": batch.column("row"),
                "doc_id": batch.column("doc_id"),
                "part": batch.column("part"),
                "n_tokens": pa.array([len(x) // 2 for x in ids], pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "base": pa.array(base_sum, pa.float64()),
                "fixed": pa.array(fixed, pa.float64()),
                "ids": pa.array(ids, pa.binary()),
                "rest": pa.ListArray.from_arrays(edges, pa.array(rest, pa.binary())),
                "rest_class": pa.ListArray.from_arrays(edges, pa.array(np.concatenate(rest_class).astype(np.int16))),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    held_out = fold(ref("doc_id"), folds) == 0
    part = F.pmod(F.xxhash64(ref("doc_id")), F.lit(16)).cast("int")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        ref("doc_id").cast("long").alias("doc_id"),
        F.when(held_out, F.lit(-1)).otherwise(part).alias("part"),
        text_of().cast("binary").alias("text"),
    )
    return rows.mapInArrow(encode, _ENCODED)


_SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, score double"


def _score_texts(encoded: DataFrame, shape: gru.Shape, weights: np.ndarray) -> DataFrame:
    """The encoded rows with the network's log10 probability added to what the head has settled."""
    state = encoded.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = gru.Model(shape, state.value)
        for pack in _packs(batches):
            logs = model.log_likelihoods(_lanes(pack, shape), len(pack))
            pack["score"] = pack["fixed"] + logs / np.log(10)
            yield pack[["row", "doc_id", "n_tokens", "n_known", "base", "score"]].astype({"doc_id": "Int64"})

    columns = ["row", "doc_id", "n_tokens", "n_known", "base", "fixed", "ids"]
    return encoded.select(*columns).mapInPandas(score, _SCORED)


def _per_class(values: np.ndarray) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("class").cast("int"))


def score_documents(docs: DataFrame, folds: int = FOLDS, head: int = HEAD, rounds=ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document."""
    held_out = fold(ref("doc_id"), folds) == 0
    learnt = docs.where(~held_out)
    counts = count_words(learnt)
    vocabulary = build_vocabulary(counts, head)
    known = docs.sparkSession.sparkContext.broadcast(pickle.dumps(vocabulary))
    encoded = stage_table(_encode(docs, known, folds), "lm-encoded")
    weights = train(encoded, vocabulary, rounds)
    scored = stage_table(_score_texts(encoded, vocabulary.shape, weights), "lm-scored")
    rare = encoded.select("row", F.explode(F.arrays_zip("rest", "rest_class")).alias("x")).select(
        "row", F.col("x.rest").alias("word"), F.col("x.rest_class").alias("class")
    )
    counted = rare.join(counts.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    share = F.when(n > 0, (n - _per_class(vocabulary.discount)) / F.greatest(_per_class(vocabulary.size), F.lit(1.0)))
    floor = float(vocabulary.total + 0.1 * (vocabulary.types + 1))
    sums = counted.groupBy("row").agg(
        F.sum((n > 0).cast("long")).alias("_known"),
        F.sum(F.log10((n + 0.1) / F.lit(floor))).alias("_base"),
        F.sum(F.log10(F.coalesce(share, _per_class(vocabulary.unknown)))).alias("_score"),
    )

    def plus(name: str, more: str) -> Column:
        return (F.col(name) + F.coalesce(F.col(more), F.lit(0))).alias(name)

    return (
        scored.join(sums, "row", "left")
        .select("doc_id", "n_tokens", plus("n_known", "_known"), plus("base", "_base"), plus("score", "_score"))
        .select(
            "doc_id",
            (fold(F.col("doc_id"), folds) == 0).alias("held_out"),
            "n_tokens",
            "n_known",
            F.lit(vocabulary.total).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"),
            "score",
        )
    )
