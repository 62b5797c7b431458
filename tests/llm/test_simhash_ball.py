from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import simhash_ball
from sluice.llm.components import connected_components
from tests.llm.conftest import ODD, SCHEMA, frame


def brute_print(text: str | None) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_ball_links_connect_what_brute_force_connects(spark, radius):
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(20)} | {0, (1 << 64) - 1}
    for _ in range(60):
        p = rng.choice(sorted(prints))
        for b in rng.sample(range(64), rng.randint(1, 5)):
            p ^= 1 << b
        prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [(r["u"], r["v"]) for r in simhash_ball.ball_links(df, radius).collect()]

    def far(a, b):
        return bin((a ^ b) & ((1 << 64) - 1)).count("1")

    assert all(far(a, b) <= radius for a, b in links)
    want = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if far(a, b) <= radius]
    assert brute_roots(signed, links) == brute_roots(signed, want)


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    links += [(5, 5), (None, 3), (160, 100), (101, 100)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for a, b in links for x in (a, b) if x is not None}
    assert got == {k: v for k, v in brute_roots(nodes, [(a, b) for a, b in links if a is not None]).items()}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows_match_brute_force(odd, nothing):
    got = simhash_ball.simhash_components(odd).withColumn("hex", simhash_ball.hex_digits(F.col("fp"))).collect()
    prints = [brute_print(r[1]) for r in ODD]
    assert sorted(r["hex"] for r in got) == sorted(f"{p:016x}" for p in prints)
    links = [(i, j) for i in range(len(ODD)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    roots = brute_roots(range(len(ODD)), links)
    want = {}
    for i, r in enumerate(ODD):
        ids = [ODD[j][0] for j in roots if roots[j] == roots[i] and ODD[j][0] is not None]
        want.setdefault((r[0], f"{prints[i]:016x}"), min(ids) if ids else None)
    assert {(r["doc_id"], r["hex"]): r["component_id"] for r in got} == want
    kept = simhash_ball.keep_one(odd)
    assert kept.columns == SCHEMA.names
    ids = [r["doc_id"] for r in kept.collect()]
    assert 2 in ids and 3 not in ids and 4 not in ids and 6 in ids and 7 not in ids and ids.count(1) == 2
    assert simhash_ball.simhash_components(nothing).count() == 0 and simhash_ball.keep_one(nothing).count() == 0


def test_a_large_group_of_copies_costs_one_fingerprint(spark):
    rows = [(i, "same text again and again here", "en", "s", 0) for i in range(500)]
    got = simhash_ball.simhash_components(frame(spark, rows)).collect()
    assert len(got) == 500 and {r["component_id"] for r in got} == {0}
