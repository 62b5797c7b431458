"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a row of measurements. Measurements are cut into bins; boosting
goes round the features, fitting one shallow tree a turn to the gradients of the
log-loss and adding it to that feature's lookup table. Then the pairs of features
whose joint bins explain most of what is left get a two-dimensional table each,
boosted the same way. A score is a sum of table entries, looked up for all rows
at once.

The model is fitted on the measurements of a bounded sample: at most ``BOUND``
labelled texts per class. Only those rows of numbers reach the driver, and a
model is a few hundred numbers. Scoring reads every text whole.

Defined cases
-------------
* null or empty text: the measurements of no words, scored like any other.
* no labelled rows, or of one class only: the score is that class's share, 0.5 where none.
* null labels are left out; of several labels of a document the largest counts.
* null ``doc_id``: scored, never learnt from. Repeated rows: scored alike.
* empty table: no rows. Extra columns: carried in the struct ``doc``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ref, text_of
from sluice.llm.labelled import training_rows

BOUND = 10_000
FOLDS = 5
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 60
RATE = 0.1
LEAVES = 4  # of a tree over one feature; over a pair one cut each way
RIDGE = 2.0
MIN_ROWS = 5
THRESHOLD = 0.3

FEATURES = (
    "words",
    "word_length",
    "symbols",
    "upper",
    "digits",
    "punctuation",
    "beyond_ascii",
    "distinct_words",
    "commonest_word",
    "repeated_lines",
    "repeated_windows",
    "line_words",
    "sentence_ends",
    "unlettered_words",
    "long_words",
    "odd_endings",
)

# Classes of bytes.
_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~{}\\=_+/", np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:!?\"'()[]-", np.uint8)
_SENTENCE_ENDS = (b".", b"!", b"?")


def measure(text: bytes | None) -> list[float]:
    """The measurements of one text, in the order of ``FEATURES``."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = chars[65:91].sum() + chars[97:123].sum() + chars[128:].sum()
    inked = max(1, int(chars.sum() - chars[[9, 10, 11, 12, 13, 32]].sum()))
    lower = text.lower().split()
    seen = Counter(lower)
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = max(1, n - 4)
    repeated = windows - len(set(zip(lower, lower[1:], lower[2:], lower[3:], lower[4:]))) if n > 4 else 0
    ends = Counter(w[-1:] for w in words)
    return [
        float(np.log1p(n)),
        inked / n,
        chars[_SYMBOLS].sum() / inked,
        chars[65:91].sum() / max(1, letters),
        chars[48:58].sum() / inked,
        chars[_PUNCTUATION].sum() / inked,
        chars[128:].sum() / inked,
        len(seen) / n,
        max(seen.values()) / n,
        1 - len(set(lines)) / len(lines),
        repeated / windows,
        n / len(lines),
        sum(ends[e] for e in _SENTENCE_ENDS) / n,
        sum(c for w, c in seen.items() if not any(b > 96 for b in w)) / n,
        sum(c for w, c in seen.items() if len(w) > 12) / n,
        sum(c for e, c in ends.items() if e in b"#*$%&|<>!") / n,
    ]


@dataclass
class Gam:
    edges: list[np.ndarray]  # per feature the inner edges of its bins
    base: float
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # per feature its bins' coarse bins
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def logits(self, b: np.ndarray) -> np.ndarray:
        z = np.full(len(b), self.base)
        for j, table in enumerate(self.tables):
            z += table[b[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            z += table[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(self.bins(x)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Value per bin of a tree over ordered bins: the best cuts one by one, at most ``leaves`` leaves."""
    cuts, spans = [], [(0, len(g))]
    for _ in range(leaves - 1):
        best = None
        for lo, hi in spans:
            cg, ch, cn = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi]), np.cumsum(n[lo:hi])
            if hi - lo < 2:
                continue
            gain = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
            gain[(cn[:-1] < MIN_ROWS) | (cn[-1] - cn[:-1] < MIN_ROWS)] = 0
            at = int(np.argmax(gain))
            if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
                best = (gain[at], lo, hi, lo + at + 1)
        if best is None:
            break
        _, lo, hi, cut = best
        spans.remove((lo, hi))
        spans += [(lo, cut), (cut, hi)]
        cuts.append(cut)
    value = np.zeros(len(g))
    for lo, hi in spans:
        value[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + RIDGE)
    return value


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best cross cut (one cut each way) of a two-dimensional table."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gain = np.zeros((g.shape[0] - 1, g.shape[1] - 1))
    for cg_, ch_ in (
        (cg[:-1, :-1], ch[:-1, :-1]),
        (cg[:-1, -1:] - cg[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1]),
        (cg[-1:, :-1] - cg[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1]),
        (cg[-1, -1] - cg[:-1, -1:] - cg[-1:, :-1] + cg[:-1, :-1], ch[-1, -1] - ch[:-1, -1:] - ch[-1:, :-1] + ch[:-1, :-1]),
    ):
        gain += _gain(cg_, ch_)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            value[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
    return float(gain[i, j] - _gain(cg[-1, -1], ch[-1, -1])), value


def _coarse(bins: np.ndarray, size: int) -> np.ndarray:
    """A coarse bin for each of ``size`` bins, of about equal numbers of rows."""
    before = np.cumsum(np.bincount(bins, minlength=size)) - np.bincount(bins, minlength=size)
    return np.minimum(before * PAIR_BINS // max(1, len(bins)), PAIR_BINS - 1)


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting of one table per feature, then of one per chosen pair."""
    share = float(y.mean()) if len(y) else 0.5
    clipped = min(max(share, 1e-9), 1 - 1e-9)
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], quantiles)) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    made = Gam(edges, float(np.log(clipped / (1 - clipped))))
    made.tables = [np.zeros(len(e) + 1) for e in edges]
    if not 0 < share < 1:
        return made
    b, z = made.bins(x), np.full(len(y), made.base)
    sizes = [len(t) for t in made.tables]
    counts = [np.bincount(b[:, j], minlength=sizes[j]) for j in range(x.shape[1])]
    for _ in range(ROUNDS):
        for j, size in enumerate(sizes):
            p = sigmoid(z)
            g = np.bincount(b[:, j], weights=y - p, minlength=size)
            h = np.bincount(b[:, j], weights=p * (1 - p), minlength=size)
            step = RATE * shallow_tree(g, h, counts[j])
            made.tables[j] += step
            z += step[b[:, j]]
    made.coarse = [_coarse(b[:, j], sizes[j]) for j in range(x.shape[1])]
    c = np.column_stack([made.coarse[j][b[:, j]] for j in range(x.shape[1])])

    def cells(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p, key = sigmoid(z), c[:, i] * PAIR_BINS + c[:, j]
        g = np.bincount(key, weights=y - p, minlength=PAIR_BINS**2)
        h = np.bincount(key, weights=p * (1 - p), minlength=PAIR_BINS**2)
        return g.reshape(PAIR_BINS, PAIR_BINS), h.reshape(PAIR_BINS, PAIR_BINS)

    gains = sorted(
        ((quadrants(*cells(i, j))[0], i, j) for i in range(x.shape[1]) for j in range(i)), key=lambda t: (-t[0], t[1:])
    )
    made.pairs = [(i, j) for _, i, j in gains[:PAIRS]]
    made.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in made.pairs]
    for _ in range(PAIR_ROUNDS):
        for table, (i, j) in zip(made.pair_tables, made.pairs):
            step = RATE * quadrants(*cells(i, j))[1]
            table += step
            z += step[c[:, i], c[:, j]]
    return made


def measure_udf():
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([measure(t) for t in texts])

    return of


def fit_model(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, bound: int = BOUND) -> Gam:
    """Measured on the executors, fitted on the driver from at most two times ``bound`` rows of numbers."""
    sample = training_rows(docs, labels, label, folds, bound).select(
        "label", "order", measure_udf()(F.col("text").cast("binary")).alias("x")
    )
    rows = sorted(((r["order"], tuple(r["x"]), r["label"]) for r in sample.toLocalIterator()))
    x = np.array([r[1] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r[2] for r in rows], dtype=float))


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, bound: int = BOUND) -> DataFrame:
    """doc (struct of the columns of ``docs``), score in 0 to 1."""
    model = docs.sparkSession.sparkContext.broadcast(fit_model(docs, labels, label, folds, bound))

    @F.pandas_udf("double")
    def scorer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([measure(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
            yield pd.Series(model.value.score(x))

    return docs.select(
        F.struct(*[ref(c) for c in docs.columns]).alias("doc"), scorer(text_of().cast("binary")).alias("score")
    )
