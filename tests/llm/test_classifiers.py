from __future__ import annotations

import random

import numpy as np
import pytest

from sluice.llm import quality_gam, toxicity
from sluice.llm.labelled import training_rows
from tests.llm.conftest import ODD, SCHEMA, frame

WORDS = [f"{a}{b}{c}" for a in ("re", "lo", "mi", "ta") for b in ("ner", "sil", "gon") for c in ("a", "es", "ing", "um", "o")]
BAD = ["vile", "nasty", "rotten"]


def corpus(rng, n):
    rows, toxic = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(20, 400))]
        bad = rng.random() < 0.2
        for _ in range(rng.randint(2, 6) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice([*BAD, "krompf" + rng.choice(WORDS)]))
        rows.append((i, " ".join(words), "en", "s", 0))
        toxic.append(int(bad))
    return rows, toxic


def test_toxic_texts_are_told_apart_on_held_out_rows(spark):
    rows, toxic = corpus(random.Random(1), 700)
    labels = spark.createDataFrame([(r[0], t) for r, t in zip(rows, toxic)], "doc_id long, toxic int")
    got = toxicity.score_documents(frame(spark, rows), labels).select("doc.doc_id", "score").collect()
    from sluice.llm.labelled import fold
    from pyspark.sql import functions as F

    held = {r["id"] for r in spark.range(700).where(fold(F.col("id"), 5) == 0).collect()}
    right = [(r["score"] >= 0.5) == bool(toxic[r["doc_id"]]) for r in got if r["doc_id"] in held]
    assert len(right) > 100 and np.mean(right) > 0.97
    kept = toxicity.drop_toxic(frame(spark, rows), labels)
    assert kept.columns == SCHEMA.names and kept.count() == sum(r["score"] < 0.5 for r in got)


def test_copies_of_a_text_do_not_teach_its_words():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(WORDS) for _ in range(60)).encode() for _ in range(300)]
    marked = texts[0]
    models = toxicity.fit(texts + [marked + b" vile nasty"] * 40, np.array([0] * 300 + [1] * 40))
    assert models is not None
    before, keys, n = toxicity._contexts([models.lexicon.ids(toxicity.tokens(marked))] * 40, models.lexicon.size)
    once = toxicity._contexts([models.lexicon.ids(toxicity.tokens(marked))], models.lexicon.size)
    assert (before == once[0]).all() and (keys == once[1]).all() and (n == once[2]).all()


def test_lower_orders_are_distributions():
    rng = random.Random(3)
    rows, toxic = corpus(rng, 120)
    cut = [toxicity.tokens(r[1].encode()) for r in rows]
    lexicon = toxicity.Lexicon(cut)
    counts = [np.array([rng.randrange(9) for _ in range(lexicon.size)], float) for _ in range(2)]
    made = toxicity._lower_orders(counts, lexicon, 2.0)
    last = [0, *lexicon.stems[-1].values()]
    for p in made:
        assert p[last].sum() == pytest.approx(1.0)
        assert (p > 0).all()


def test_quality_is_told_apart_on_held_out_rows(spark):
    rng, rows, good = random.Random(4), [], []
    for i in range(600):
        words = [rng.choice(WORDS) for _ in range(rng.randint(10, 200))]
        ok = rng.random() < 0.7
        if not ok:
            kind = rng.randrange(3)
            words = [w + "###" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else words[:3] * 20
        rows.append((i, " ".join(words), "en", "s", 0))
        good.append(int(ok))
    labels = spark.createDataFrame([(r[0], g) for r, g in zip(rows, good)], "doc_id long, quality int")
    got = quality_gam.score_documents(frame(spark, rows), labels).select("doc.doc_id", "score").collect()
    right = [(r["score"] >= 0.3) == bool(good[r["doc_id"]]) for r in got]
    assert np.mean(right) > 0.98


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    made = quality_gam.fit(x, y)
    assert (0, 1) in [tuple(sorted(p)) for p in made.pairs]
    assert ((made.score(x) >= 0.5) == (y > 0)).mean() > 0.9


@pytest.mark.parametrize("operator", [toxicity, quality_gam])
def test_odd_rows_labels_and_empty_tables(odd, nothing, odd_labels, no_labels, operator):
    for docs, labels, n in ((odd, odd_labels, len(ODD)), (odd, no_labels, len(ODD)), (nothing, odd_labels, 0), (nothing, no_labels, 0)):
        rows = operator.score_documents(docs, labels).collect()
        assert len(rows) == n and all(0 <= r["score"] <= 1 for r in rows)


def test_training_rows_leave_out_the_held_fold_and_stay_bounded(spark, odd, odd_labels):
    rows, _ = corpus(random.Random(6), 200)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    import zlib

    got = training_rows(frame(spark, rows), labels, "toxic", 5, 10_000).collect()
    texts = {r[1]: r[0] for r in rows}
    assert sorted(texts[r["text"]] for r in got) == [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    few = training_rows(frame(spark, rows), labels, "toxic", 5, 7).collect()
    assert sorted(r["label"] for r in few) == [0] * 7 + [1] * 7
    assert all(r["label"] in (0, 1) for r in training_rows(odd, odd_labels, "toxic", 5, 10).collect())


def test_measures_of_odd_texts():
    for text in (None, b"", b" \t\n", b"a", "é\U0001f600　".encode(), b"| | |", b"x " * 50_000):
        m = quality_gam.measure(text)
        assert len(m) == len(quality_gam.FEATURES) and np.isfinite(m).all()


def slow_kneser_ney(cut, labels, lexicon, discount):
    """P(word), back-off weight and P(second | first) of both classes, from sets of contexts and plain loops."""
    out = []
    types, contexts = [], []
    for of in (1, 0):
        mine = [[lexicon.id(w) for w in t] for t, y in zip(cut, labels) if y == of]
        before, pairs = {}, {}
        for ids in mine:
            for k in range(1, len(ids)):
                before.setdefault(ids[k], set()).add(ids[k - 1])
                found = pairs.setdefault((ids[k - 1], ids[k]), set())
                if k > 1:
                    found.add(ids[k - 2])
        seen = {}
        for w in {w for t, y in zip(cut, labels) if y == of for w in t}:
            stems = [lexicon.stems[k].get(w[:n]) for k, n in enumerate(toxicity.STEMS)]
            for s in {*(x for x in stems if x is not None), *([0] if stems[-1] is None else [])}:
                seen.setdefault(s, set()).add(w)
        words = set(lexicon.words.values())
        types.append({i: len(before.get(i, ())) if i in words else len(seen.get(i, ())) for i in range(lexicon.size)})
        contexts.append({p: len(x) for p, x in pairs.items()})
    pooled = {i: types[0][i] + types[1][i] + 1 for i in range(lexicon.size)}
    parents = [(list(own), list(parent)) for own, parent in lexicon.levels]
    for n, pair in zip(types, contexts):
        last = [0, *lexicon.stems[-1].values()]
        total = max(1, sum(n[i] for i in last))
        held = sum(min(n[i], discount) for i in last)
        p = {}
        for i in last:
            rest = (held if sum(n[j] for j in last) else 1) / total
            p[i] = max(n[i] - discount, 0) / total + rest * pooled[i] / sum(pooled[j] for j in last)
        for own, parent in parents:
            total = max(1, sum(n[i] for i in own))
            weight = sum(min(n[i], discount) for i in own) / total if any(n[i] for i in own) else 1
            for i, up in zip(own, parent):
                brothers = sum(pooled[j] for j, q in zip(own, parent) if q == up)
                p[i] = max(n[i] - discount, 0) / total + weight * p[up] * pooled[i] / brothers
        out.append((p, pair))
    return out


def test_models_match_slow_kneser_ney():
    rng = random.Random(8)
    rows, labels = corpus(rng, 60)
    cut = [toxicity.tokens(r[1].encode())[:60] for r in rows]
    lexicon = toxicity.Lexicon(cut)
    ids = [lexicon.ids(t) for t in cut]
    labels = np.array(labels)
    for discount in (0.75, 2.0):
        made = toxicity.train(lexicon, toxicity.count(lexicon, cut, ids, labels), discount)
        slow = slow_kneser_ney(cut, labels, lexicon, discount)

        def given(c, first, second):
            p, pairs = slow[c]
            after = sum(n for (a, _), n in pairs.items() if a == first)
            freed = sum(min(n, discount) for (a, _), n in pairs.items() if a == first)
            back = (freed + toxicity.PRIOR) / (after + toxicity.PRIOR)
            return max(pairs.get((first, second), 0) - discount, 0) / (after + toxicity.PRIOR) + back * p[second]

        words = list(lexicon.words.values())[:30]
        for text in [ids[0], ids[1], np.array([words[0], words[0], 0, words[5]])]:
            first = np.zeros(len(text), bool)
            first[0] = True
            got = made.differences(text, first)
            want = [np.log(slow[0][0][text[0]]) - np.log(slow[1][0][text[0]])]
            want += [np.log(given(0, a, b)) - np.log(given(1, a, b)) for a, b in zip(text, text[1:])]
            assert got == pytest.approx(want)
        # What may follow a word shares out the whole of its probability.
        for c in (0, 1):
            mass = sum(slow[c][0][i] for i in range(lexicon.size))
            for a in words[:5]:
                pairs = slow[c][1]
                after = sum(n for (x, _), n in pairs.items() if x == a)
                freed = sum(min(n, discount) for (x, _), n in pairs.items() if x == a)
                total = sum(given(c, a, b) for b in range(lexicon.size))
                assert total == pytest.approx((after - freed + (freed + toxicity.PRIOR) * mass) / (after + toxicity.PRIOR))


def test_gam_scores_are_sums_of_looked_up_bins():
    rng = np.random.default_rng(6)
    x = rng.random((800, 4)).round(2)
    y = ((x[:, 0] > 0.4) ^ (x[:, 2] > 0.7)).astype(float)
    made = quality_gam.fit(x, y)
    for row, score in zip(x[:60], made.score(x[:60])):
        at = [sum(edge <= value for edge in edges) for edges, value in zip(made.edges, row)]
        z = made.base + sum(table[k] for table, k in zip(made.tables, at))
        z += sum(t[made.coarse[i][at[i]], made.coarse[j][at[j]]] for (i, j), t in zip(made.pairs, made.pair_tables))
        assert score == pytest.approx(1 / (1 + np.exp(-z)))


def test_the_first_cut_of_a_shallow_tree_is_the_best_one():
    rng = np.random.default_rng(7)
    for _ in range(20):
        g, h, n = rng.normal(size=12), rng.random(12) + 0.1, np.full(12, 10_000)
        value = quality_gam.shallow_tree(g, h, n, leaves=2)
        ridge = quality_gam.RIDGE

        def gain(cut):
            return sum(g[s].sum() ** 2 / (h[s].sum() + ridge) for s in (slice(0, cut), slice(cut, 12)))

        cut = max(range(1, 12), key=gain)
        if gain(cut) - g.sum() ** 2 / (h.sum() + ridge) > 1e-9:
            assert value[0] == pytest.approx(g[:cut].sum() / (h[:cut].sum() + ridge))
            assert value[-1] == pytest.approx(g[cut:].sum() / (h[cut:].sum() + ridge))


def test_the_best_cross_cut_is_found():
    rng = np.random.default_rng(9)
    for _ in range(20):
        g, h = rng.normal(size=(5, 6)), rng.random((5, 6)) + 0.1
        ridge = quality_gam.RIDGE

        def gain(i, j):
            parts = [(r, c) for r in (slice(0, i), slice(i, 5)) for c in (slice(0, j), slice(j, 6))]
            return sum(g[p].sum() ** 2 / (h[p].sum() + ridge) for p in parts)

        best = max(gain(i, j) for i in range(1, 5) for j in range(1, 6))
        assert quality_gam.quadrants(g, h)[0] == pytest.approx(best - g.sum() ** 2 / (h.sum() + ridge))
