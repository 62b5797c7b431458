from __future__ import annotations

import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import decontaminate
from tests.llm.conftest import ODD, SCHEMA, frame

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def cut(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items):
    out = []
    for d, text in docs:
        w = cut(text)
        hit, ids = set(), set()
        for item_id, body in items:
            b = cut(body)
            n = min(10, len(b))
            wins = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    ids.add("" if item_id is None else str(item_id))
        out.append((str(d), len(w), len(hit), sorted(ids)))
    return sorted(out)


def result(df):
    return sorted((str(r["doc"]["doc_id"]), r["n_words"], r["n_hit"], list(r["items"])) for r in df.collect())


def bench(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")


def test_matches_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "x-y", "Don't"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 14, 30]))) for i in range(25)]
    items += [(100, ""), (101, None), (102, "..."), (None, "null item of its own"), (0, items[0][1]), (103, items[3][1])]
    docs = []
    for i in range(60):
        body = text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            words = (items[rng.randrange(25)][1] or "").split()
            at = rng.randint(0, max(0, len(words) - 10))
            body += " , " + " ".join(words[at : at + rng.randint(8, 20)]).upper() + " " + text(5)
        docs.append((i, body, "en", "s", 0))
    docs += [(60, "NULL item... of/its own", "en", "s", 0), (60, "another text", "en", "s", 0), (None, items[5][1], "en", "s", 0)]
    got = decontaminate.mark_contaminated(frame(spark, docs), bench(spark, items))
    want = brute([(d[0], d[1]) for d in docs], items)
    assert result(got) == want and sum(r[2] > 0 for r in want) > 20


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    items = [(1, ODD[0][1]), (2, "word"), (3, ODD[6][1][:400])]
    assert result(decontaminate.mark_contaminated(odd, bench(spark, items))) == brute([(r[0], r[1]) for r in ODD], items)
    kept = decontaminate.drop_contaminated(odd, bench(spark, items))
    assert kept.columns == SCHEMA.names
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "4", "5", "None"]
    assert decontaminate.mark_contaminated(nothing, bench(spark, items)).count() == 0
    assert decontaminate.drop_contaminated(odd, bench(spark, [])).count() == len(ODD)


def test_index_and_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = frame(spark, [
        (1, "x " + item, "", "", 0),
        (2, item.replace("delta", "delta and more"), "", "", 0),
        (3, " ".join(reversed(item.split())), "", "", 0),
    ])
    windows = decontaminate.item_windows(bench(spark, [(1, item)]))
    chosen = decontaminate.choose_anchors(windows, decontaminate.term_counts(docs, windows.select("term")), 10)
    index = decontaminate.build_index(docs, chosen.select("term"))
    positions = {(r["doc_id"], r["term"]): list(r["positions"]) for r in index.collect()}
    assert positions[1, "alpha"] == [1] and positions[2, "kappa"] == [11] and positions[3, "kappa"] == [0]
    exact = decontaminate.phrase_candidates(index, chosen).select("doc_id", F.explode("ws").alias("w"), "diagonal")
    assert [tuple(r) for r in exact.collect()] == [(1, 0, 1)]
    near = decontaminate.proximity_matches(index, chosen, slop=3).collect()
    assert sorted((r["doc_id"], r["start"], r["spread"]) for r in near) == [(1, 1, 0), (2, 0, 2)]


def test_near_windows_are_verified(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rare = ["alpha", "kappa"]  # the anchors: every other word is common
    common = " ".join(w for w in item.split() if w not in rare)
    docs = [(100 + i, common, "", "", 0) for i in range(5)] + [
        (1, "x " + item, "", "", 0),
        (2, item.replace("delta", "delta and more"), "", "", 0),
        (3, item.replace("delta", "other").replace(" eta ", " new "), "", "", 0),
        (4, "alpha kappa of nothing else and no other word of it", "", "", 0),
        (5, "alpha one two beta three four five six eight nine kappa", "", "", 0),
        (None, item.replace("gamma", "changed and"), "", "", 0),
        (None, "some other text", "", "", 0),
    ]
    marked = decontaminate.mark_contaminated(frame(spark, docs), bench(spark, [(7, item)]), slop=3).collect()
    got = sorted((str(r["doc"]["doc_id"]), list(r["items"]), list(r["near_items"])) for r in marked if r["doc"]["doc_id"] not in range(100, 105))
    assert got == [
        ("1", ["7"], []), ("2", [], ["7"]), ("3", [], ["7"]), ("4", [], []), ("5", [], []), ("None", [], []), ("None", [], ["7"]),
    ]


@given(st.lists(st.integers(0, 3), max_size=8), st.lists(st.integers(0, 3), max_size=9))
def test_words_in_order(phrase, tokens):
    best = 0
    for pick in range(1 << len(phrase)):
        part, at = [w for i, w in enumerate(phrase) if pick >> i & 1], 0
        for t in tokens:
            at += at < len(part) and part[at] == t
        best = max(best, len(part) if at == len(part) else 0)
    assert decontaminate.in_order(phrase, tokens) == best


@pytest.mark.parametrize("c", range(256))
def test_terms_part_as_the_pattern(c):
    ch = chr(c)
    assert [t.decode() for t in decontaminate.terms(f"a{ch}B".encode())] == cut(f"a{ch}B")
