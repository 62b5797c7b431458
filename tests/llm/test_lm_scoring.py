from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import gru, lm_scoring
from tests.llm.conftest import ODD, frame


def small(seed=0, leading=2, classes=4, hidden=4):
    shape = gru.Shape(leading * gru.MEMBERS + (classes - leading) + 1, leading, classes, hidden)
    flat = (np.random.default_rng(seed).standard_normal(shape.size()) * 0.3).astype(np.float32)
    return gru.Model(shape, flat)


def some_texts(model, rng, n, longest=40):
    return [
        np.array([rng.randrange(model.shape.inputs - 1) for _ in range(rng.randint(1, longest))], np.int16) for _ in range(n)
    ]


def slow_log(model, text):
    """One text, one token at a time."""
    w, k = model.w, model.shape.hidden
    h, x, total = np.zeros(k), model.shape.inputs - 1, 0.0
    sig = lambda v: 1 / (1 + np.exp(-v))
    for i, c, m in zip(text, *model.shape.split(text)):
        a, g = w["embed"][x].astype(float), h @ w["recur"].astype(float)
        z, r = sig(a[:k] + g[:k]), sig(a[k : 2 * k] + g[k : 2 * k])
        h = (1 - z) * np.tanh(a[2 * k :] + r * g[2 * k :]) + z * h
        p = np.exp(h @ w["to_class"] + w["class_bias"])
        total += math.log(p[c] / p.sum())
        if m >= 0:
            p = np.exp(h @ w["to_member"][c] + w["member_bias"][c])
            total += math.log(p[m] / p.sum())
        x = i
    return total


def test_state_is_carried_across_windows_and_lanes():
    model, rng = small(), random.Random(1)
    texts = some_texts(model, rng, 25)
    for lanes, window in ((1, 3), (7, 5), (64, 100)):
        got = model.log_likelihoods(gru.pack(texts, model.shape.inputs - 1, lanes), len(texts), window)
        assert got == pytest.approx([slow_log(model, t) for t in texts], rel=1e-4)


def test_gradients_match_differences():
    model, rng = small(3), random.Random(2)
    texts = some_texts(model, rng, 5, longest=9)
    lanes = gru.pack(texts, model.shape.inputs - 1, 3)
    window = len(lanes.x)  # whole texts, so nothing is truncated
    caught = {}
    model._step = lambda g, squares, rate: caught.update(g)
    model.train(lanes, np.zeros_like(model.flat), window=window)
    views = model.shape.views(model.flat)
    dense = np.zeros_like(views["embed"])
    dense[caught["embed"][0]] = caught["embed"][1]
    caught["embed"] = dense
    for name in ("embed", "recur", "to_class", "class_bias", "to_member", "member_bias"):
        flat = views[name].reshape(-1)
        for i in np.argsort(-np.abs(caught[name].reshape(-1)))[:4]:
            kept, both = flat[i], []
            for d in (1e-2, -1e-2):
                flat[i] = kept + d
                both.append(-sum(slow_log(model, t) for t in texts))
            flat[i] = kept
            assert caught[name].reshape(-1)[i] * gru.LANES == pytest.approx((both[0] - both[1]) / 2e-2, rel=0.02, abs=1e-3)


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows = random.Random(4), []
    for i in range(400):
        lang = i % 2
        words = [f"{'ab'[lang]}{min(int(rng.expovariate(0.02)), 900)}" for _ in range(rng.randint(1, 80))]
        rows.append((i, " ".join(words).upper() if i % 5 else "\n".join(words), "en", "s", 0))
    return rows


@pytest.mark.parametrize("head", [100, 200_000])
def test_base_matches_brute_force_and_the_model_beats_it(spark, corpus, head):
    got = lm_scoring.score_documents(frame(spark, corpus), head=head).collect()
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in corpus}
    cut = {r[0]: r[1].lower().split() + [""] for r in corpus}
    c = Counter(w for d, ws in cut.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(corpus)
    for r in got:
        ws = cut[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), n)
        assert r["n_known"] == sum(c[w] > 0 for w in ws)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 0.1 * sum(r["n_tokens"] for r in out)


def test_next_token_probabilities_sum_to_one(spark, corpus):
    """Known words and one unknown word per trailing class share exactly the whole mass."""
    counts = lm_scoring.count_words(frame(spark, corpus))
    vocabulary = lm_scoring.build_vocabulary(counts)
    trailing = vocabulary.members < 0
    mass = np.zeros(vocabulary.shape.classes)
    np.add.at(mass, vocabulary.classes[trailing], 10 ** vocabulary.fixed[trailing])
    mass += vocabulary.unknown
    assert mass[lm_scoring.LEADING :] == pytest.approx(1.0)
    assert counts.count() == len(vocabulary.words)


def test_a_task_sends_each_word_once_however_many_batches_it_reads(spark):
    rows = [(i, f"the cat {i % 7}" if i % 3 else None, "en", "s", 0) for i in range(25_000)]
    got = lm_scoring.task_counts(frame(spark, rows).coalesce(1)).collect()
    want = Counter(w for r in rows for w in lm_scoring.tokens((r[1] or "").encode()))
    want[lm_scoring.END] = len(rows)
    assert len(got) == len(want) and {bytes(r["word"]): r["n"] for r in got} == want


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    got = lm_scoring.score_documents(odd).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted(
        (str(d), len((t or "").encode().split()) + 1) for d, t, *_ in ODD
    )
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert lm_scoring.score_documents(nothing).count() == 0
    unlearnt = lm_scoring.score_documents(odd.where("doc_id is null")).collect()
    assert len(unlearnt) == 2 and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in unlearnt)
