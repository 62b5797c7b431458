"""Toxicity by class-conditional Kneser-Ney language models.

Two bigram models, one of the toxic and one of the ordinary labelled texts. A
pair backs off to its word, a word to its stems (the first ``STEMS`` bytes), and
the last stem to counts shared by both classes. As Kneser and Ney have it, what
is counted is in how many different contexts an expression stands: words before
a pair or a word, words with a stem. Copies of a text thus count once, and an
expression that a class has hardly seen is discounted to its stem and to the
shared counts in both models alike, so rare expressions tell little.

A text is scored by the length-normalised difference of its log-likelihoods,
over the whole text and over its best windows, so a few words weigh in a long
text too; a logistic fit on texts that the models had not seen turns the
differences into a probability.

The models are fitted on a bounded sample: at most ``BOUND`` labelled texts per
class, ``MAX_WORDS`` words, ``MAX_STEMS`` stems a level and ``MAX_PAIRS`` pairs.
What is broadcast therefore does not grow with the corpus. Scoring reads every
text whole.

Defined cases
-------------
* null or empty text: no evidence; the score is the fitted score of no difference.
* no labelled rows of one class: every score is 0.
* null labels are left out; of several labels of a document the largest counts.
* null ``doc_id``: scored, never learnt from. Repeated rows: scored alike.
* empty table: no rows. Extra columns: carried in the struct ``doc``.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ref, text_of
from sluice.llm.labelled import training_rows

BOUND = 5000
MAX_WORDS = 200_000
MAX_PAIRS = 300_000
MAX_STEMS = 100_000
STEMS = (6, 4)
FOLDS = 5
DISCOUNTS = (0.75, 2.0, 4.0, 8.0, 16.0)  # tried on texts kept out of the counts
PRIOR = 5.0  # a first word of fewer contexts is filled up with the lower order
WINDOWS = (1, 8, 64)  # words of the windows whose best mean difference counts
THRESHOLD = 0.5
SLICE = 8 << 20  # bytes of text scored at a time


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased words without the punctuation around them."""
    return [w.strip(b".,;:!?\"'()[]") or w for w in text.lower().split()] if text else []


class Lexicon:
    """Ids of words and stems: 0 is anything else, then the words, then the stems of each level."""

    def __init__(self, texts: list[list[bytes]]):
        seen = Counter(w for t in texts for w in t)
        types = [Counter(w[:k] for w in seen) for k in STEMS]
        self.words = _numbered(seen, 1, MAX_WORDS)
        at = len(self.words) + 1
        self.stems = []
        for k, found in zip(STEMS, types):
            self.stems.append(_numbered(found, at, MAX_STEMS))
            at += len(self.stems[-1])
        self.size = at
        # Levels from the last stems up to the words: their ids, and the ids of their parents a level below.
        self.levels = []
        for level, known in [(k + 1, self.stems[k]) for k in reversed(range(len(STEMS) - 1))] + [(0, self.words)]:
            own = np.fromiter(known.values(), np.int64, len(known))
            self.levels.append((own, np.fromiter((self.stem(x, level) for x in known), np.int64, len(known))))

    def id(self, word: bytes) -> int:
        """The word if known, else its longest known stem."""
        found = self.words.get(word)
        return found if found is not None else self.stem(word)

    def stem(self, word: bytes, level: int = 0) -> int:
        for k, ids in list(zip(STEMS, self.stems))[level:]:
            found = ids.get(word[:k])
            if found is not None:
                return found
        return 0

    def ids(self, words: list[bytes]) -> np.ndarray:
        get, of = self.words.get, self.stem
        return np.array([get(w) or of(w) for w in words], dtype=np.int64)


def _numbered(counts: Counter, start: int, most: int) -> dict:
    """The keys counted twice or more, the most frequent first, numbered from ``start``."""
    often = sorted((x for x, n in counts.items() if n >= 2), key=lambda x: (-counts[x], x))[:most]
    return {x: start + i for i, x in enumerate(often)}


@dataclass
class ClassModels:
    lexicon: Lexicon
    word_ratio: np.ndarray  # log P(id | toxic) - log P(id | ordinary) without context
    backoff_ratio: np.ndarray  # the same of the backoff weight after each id
    pairs: np.ndarray  # sorted keys of the known pairs
    pair_ratio: np.ndarray
    weights: np.ndarray | None = None  # logistic weights, the last is the bias

    def ids(self, text: bytes | None) -> np.ndarray:
        return self.lexicon.ids(tokens(text))

    def differences(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per word the difference of its conditional log-likelihoods; ``first`` marks words without one before them."""
        diff = self.word_ratio[ids].copy()
        later = np.flatnonzero(~first)
        before = ids[later - 1]
        diff[later] += self.backoff_ratio[before]
        if len(self.pairs) and len(later):
            keys = before * len(self.word_ratio) + ids[later]
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            known = self.pairs[at] == keys
            diff[later[known]] = self.pair_ratio[at[known]]
        return diff

    def features(self, texts: list[np.ndarray]) -> np.ndarray:
        """Per text its mean difference, and the largest mean of its windows of each size; zeros for no words."""
        out = np.zeros((len(texts), 1 + len(WINDOWS)))
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        full = np.flatnonzero(sizes)
        if not len(full):
            return out
        n = sizes[full]
        ends = np.cumsum(n)
        starts = ends - n
        ids = np.concatenate([texts[i] for i in full])
        first = np.zeros(len(ids), bool)
        first[starts] = True
        sums = np.concatenate(([0.0], np.cumsum(self.differences(ids, first))))
        mean = (sums[ends] - sums[starts]) / n
        out[full, 0] = mean
        for k, w in enumerate(WINDOWS, start=1):
            best = np.full(len(ids), -np.inf)
            if len(ids) >= w:
                best[: len(ids) - w + 1] = (sums[w:] - sums[:-w]) / w
            best[np.arange(len(ids)) + w > np.repeat(ends, n)] = -np.inf  # windows that leave their text
            out[full, k] = np.where(n >= w, np.maximum.reduceat(best, starts), mean)
        return out

    def score(self, ids: np.ndarray) -> float:
        """Score of one text's ids."""
        return float(self._probability(self.features([ids]))[0])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Scores of many texts, their windows taken together."""
        out = np.zeros(len(texts))
        for part in _slices(texts):
            out[part] = self._probability(self.features([self.ids(t) for t in texts[part]]))
        return out

    def _probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _slices(texts: list[bytes]) -> Iterator[slice]:
    """Runs of texts of about ``SLICE`` bytes, one text at least."""
    lo = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= SLICE or i == len(texts) - 1:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0


def _distinct(keys: list[np.ndarray]) -> np.ndarray:
    """Sorted distinct keys."""
    if not keys:
        return np.zeros(0, np.int64)
    found = np.concatenate(keys)
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))] if len(found) else found


def _contexts(texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different ids before each id; sorted pair keys and the different ids before each pair."""
    pairs = [ids[:-1] * size + ids[1:] for ids in texts if len(ids) > 1]
    keys = _distinct(pairs)
    before = np.bincount(keys % size, minlength=size)
    # Pairs are numbered, so that a pair and the id before it fit one key.
    longer = [np.searchsorted(keys, p[1:]) * size + ids[:-2] for p, ids in zip(pairs, (t for t in texts if len(t) > 1))]
    triples = _distinct(longer)
    return before, keys, np.bincount(triples // size, minlength=len(keys))


def _types(texts: list[list[bytes]], lexicon: Lexicon) -> np.ndarray:
    """Different words of each stem, at the stem's id; words without a known stem count at 0."""
    found = np.zeros(lexicon.size, dtype=np.int64)
    for w in {w for t in texts for w in t}:
        for level in range(len(STEMS)):
            at = lexicon.stems[level].get(w[: STEMS[level]])
            if at is not None:
                found[at] += 1
            elif level == len(STEMS) - 1:
                found[0] += 1
    return found


def _lower_orders(counts: list[np.ndarray], lexicon: Lexicon, discount: float) -> list[np.ndarray]:
    """Per class P(id): from the shared counts up the stems to the words."""
    pooled = counts[0] + counts[1] + 1.0
    made = [np.zeros(lexicon.size) for _ in counts]
    ground = lexicon.stems[-1]
    last = np.concatenate(([0], np.fromiter(ground.values(), np.int64, len(ground))))
    for c, n in enumerate(counts):
        total = max(1.0, float(n[last].sum()))
        held = np.minimum(n[last], discount)
        shared = pooled[last] / pooled[last].sum()
        rest = held.sum() if n[last].sum() else 1.0
        made[c][last] = (n[last] - held + rest * shared) / total
    for own, parent in lexicon.levels:
        if not len(own):
            continue
        part = pooled[own] / np.bincount(parent, weights=pooled[own], minlength=lexicon.size)[parent]
        for c, n in enumerate(counts):
            total = max(1.0, float(n[own].sum()))
            held = np.minimum(n[own], discount)
            weight = held.sum() / total if n[own].sum() else 1.0
            made[c][own] = (n[own] - held) / total + weight * made[c][parent] * part
    return made


def count(lexicon: Lexicon, texts: list[list[bytes]], ids: list[np.ndarray], labels: np.ndarray) -> tuple[list, list]:
    """Per class (toxic, ordinary) the contexts of each id, and the pairs with theirs: all that the models are made of."""
    size, counts, parts = lexicon.size, [], []
    for mine in (np.flatnonzero(labels), np.flatnonzero(labels == 0)):
        before, keys, n = _contexts([ids[i] for i in mine], size)
        types = _types([texts[i] for i in mine], lexicon)
        stems = np.arange(size) > len(lexicon.words)
        stems[0] = True
        counts.append(np.where(stems, types, before).astype(float))
        parts.append((keys, n.astype(float)))
    return counts, parts


def train(lexicon: Lexicon, counted: tuple[list, list], discount: float) -> ClassModels:
    """Interpolated Kneser-Ney models of both classes."""
    size, (counts, parts) = lexicon.size, counted
    lower = _lower_orders(counts, lexicon, discount)
    keys = _distinct([p[0] for p in parts])
    pair_counts = np.zeros((2, len(keys)))
    for c, (own, n) in enumerate(parts):
        pair_counts[c, np.searchsorted(keys, own)] = n
    # A pair below the discount in both classes only frees weight for its word.
    known = pair_counts.max(axis=0) > discount
    if known.sum() > MAX_PAIRS:
        known &= pair_counts.sum(axis=0) > np.partition(pair_counts.sum(axis=0), -MAX_PAIRS)[-MAX_PAIRS]
    kept, kept_counts = keys[known], pair_counts[:, known]
    first, second = kept // size, kept % size
    pair_logs, backoffs = [], []
    for c, (own, n) in enumerate(parts):
        after = np.bincount(own // size, weights=n, minlength=size)
        freed = np.bincount(own // size, weights=np.minimum(n, discount), minlength=size)
        back = (freed + PRIOR) / (after + PRIOR)
        pair_logs.append(
            np.log(np.maximum(kept_counts[c] - discount, 0) / (after[first] + PRIOR) + back[first] * lower[c][second])
        )
        backoffs.append(np.log(back))
    return ClassModels(
        lexicon,
        np.log(np.maximum(lower[0], 1e-300)) - np.log(np.maximum(lower[1], 1e-300)),
        backoffs[0] - backoffs[1],
        kept,
        pair_logs[0] - pair_logs[1],
    )


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights and bias by Newton's method with a small ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def log_loss(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    z = np.column_stack([x, np.ones(len(x))]) @ w
    return float(np.mean(np.logaddexp(0, np.where(y > 0, -z, z))))


def fit(texts: list[bytes], labels: np.ndarray) -> ClassModels | None:
    """Models of all texts; discount and logistic weights are chosen by two-fold cross-fitting."""
    labels = np.asarray(labels)
    if not len(labels) or labels.min() == labels.max():
        return None
    cut = [tokens(t) for t in texts]
    lexicon = Lexicon(cut)
    ids = [lexicon.ids(t) for t in cut]
    half = np.arange(len(cut)) % 2

    def of(keep: np.ndarray) -> tuple[list, list]:
        mine = np.flatnonzero(keep)
        return count(lexicon, [cut[i] for i in mine], [ids[i] for i in mine], labels[mine])

    sides = [of(half == side) for side in (0, 1)]
    best = None
    for discount in DISCOUNTS:
        x = np.zeros((len(ids), 1 + len(WINDOWS)))
        for side in (0, 1):
            own = train(lexicon, sides[side], discount)
            others = np.flatnonzero(half != side)
            x[others] = own.features([ids[i] for i in others])
        w = logistic(x, labels)
        loss = log_loss(x, labels, w)
        if best is None or loss < best[0]:
            best = (loss, discount, w)
    made = train(lexicon, of(half >= 0), best[1])
    made.weights = best[2]
    lexicon.levels = []  # only training needs them
    return made


def fit_models(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, bound: int = BOUND) -> bytes:
    """The pickled models, fitted in one task on the bounded sample."""
    sample = training_rows(docs, labels, label, folds, bound)

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "text"]).drop_duplicates("text")
        made = fit(list(rows["text"]), rows["label"].to_numpy())
        return pd.DataFrame({"model": [pickle.dumps(made)]})

    got = (
        sample.select(F.col("text").cast("binary").alias("text"), "label", "order", F.lit(0).alias("_all"))
        .groupBy("_all")
        .applyInPandas(learn, "model binary")
        .first()
    )
    return bytes(got["model"]) if got else pickle.dumps(None)


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, bound: int = BOUND) -> DataFrame:
    """doc (struct of the columns of ``docs``), score in 0 to 1."""
    packed = docs.sparkSession.sparkContext.broadcast(fit_models(docs, labels, label, folds, bound))

    @F.pandas_udf("double")
    def scorer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        models = pickle.loads(packed.value)
        for texts in batches:
            if models is None:
                yield pd.Series(np.zeros(len(texts)))
            else:
                yield pd.Series(models.scores(list(texts)), dtype="float64")

    return docs.select(
        F.struct(*[ref(c) for c in docs.columns]).alias("doc"), scorer(text_of().cast("binary")).alias("score")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents scored at the threshold or above."""
    return score_documents(docs, labels).where(F.col("score") < threshold).select("doc.*")
