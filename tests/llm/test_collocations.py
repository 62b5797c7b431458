"""Collocations against a brute-force version, over blocks and shards of any size."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from sluice.llm import collocations
from tests.llm.conftest import ODD, frame


def brute(rows, min_count, max_words=4, top=2000):
    n, f = Counter(), Counter()
    for _id, text, lang, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    longer = {}
    for (lang, words), a in found.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                inner = (lang, words[i : i + m])
                longer[inner] = max(longer.get(inner, 0), a)
    out = []
    for (lang, words), a in found.items():
        if 100 * longer.get((lang, words), 0) >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks = Counter()
    result = []
    for r in out:
        ranks[r[0]] += 1
        if ranks[r[0]] <= top:
            result.append((r[0], ranks[r[0]], *r[1:]))
    return sorted(result)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["a", "b", "C", "d", "é", "ü", "x-y", "zz", "\x0b", "\U0001f600", "Ab", "#"]
    seps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! ", "\r"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocab[: rng.choice([3, 5, 12])]) + rng.choice(seps) for _ in range(rng.randrange(60)))
        if rng.random() < 0.4:
            text += "one two three four"
        rows.append((rng.randrange(9), text, rng.choice(["en", "en", "de", None, "und"]), "s", 1))
    return rows


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("block_bytes, shard_entries", [(1 << 24, 1 << 21), (300, 7)])
def test_matches_brute_force(spark, block_bytes, shard_entries):
    rows = corpus(1, 120)
    got = collocations.collocations(
        frame(spark, rows).repartition(5), min_count=4, block_bytes=block_bytes, shard_entries=shard_entries
    )
    want = brute(rows, 4)
    assert len(want) > 50 and rows_of(got) == want


def test_odd_rows_ties_and_top(spark):
    rows = ODD * 3
    assert rows_of(collocations.collocations(frame(spark, rows), min_count=2, top=5)) == brute(rows, 2, top=5)


def test_nothing_found(spark, nothing):
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(frame(spark, ODD[:3]), min_count=5).count() == 0


def test_phrases_of_two_words_only(spark):
    rows = corpus(2, 40)
    assert rows_of(collocations.collocations(frame(spark, rows), min_count=3, max_words=2)) == brute(rows, 3, max_words=2)


def test_products_beyond_64_bits_are_exact(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 2 * big - 1, 3)], "a long, l long, r long")
    score = "(cast(a as decimal(19,0)) * 2000000BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    assert df.selectExpr(f"{score} AS s").first()["s"] == 2_000_000 * big // (2 * big + 2)
