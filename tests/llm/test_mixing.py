from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import mixing
from tests.llm.conftest import EXTRA, ODD, SCHEMA, frame


def water_fill(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Targets by resharing the excess until no source is above its ceiling."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    while True:
        open_ = [s for s in order if s not in full]
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] for s in full}
        target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if target[s] > most * sizes[s] * (1 + 1e-12)}
        if not above:
            return target
        full |= above


def test_targets_follow_repeated_resharing(spark):
    sizes = {"b": 5, "a": 900, "z": 40, "é": 300, None: 7, "m": 0, "c": 1}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(water_fill(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_copies_follow_rate_and_reruns_agree(spark):
    rows = [(i, " ".join(["w"] * 10), "en", "a" if i % 10 else "b", 0) for i in range(2000)]
    docs = frame(spark, rows)
    plan = mixing.plan_mix(docs).collect()
    for source in ("a", "b"):
        mine = [r for r in plan if r["source"] == source]
        taken = sum(r["size"] * r["copies"] for r in mine)
        assert taken == pytest.approx(mine[0]["target"], rel=0.1)
        rate = mine[0]["target"] / mine[0]["source_size"]
        assert {r["copies"] for r in mine} <= {int(rate), int(rate) + 1}
    again = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in plan}
    mixed = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert mixed == Counter({d: n for d, n in again.items() if n})


def test_odd_rows(odd, nothing):
    plan = mixing.plan_mix(odd).collect()
    assert len(plan) == len(ODD)
    assert all(r["copies"] <= 3 for r in plan)
    sizes = {}
    for d, text, _, source, _ in ODD:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    target = water_fill(sizes)
    for r in plan:
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
    assert mixing.mix(odd).columns == SCHEMA.names
    assert {r["a.b"] for r in mixing.mix(odd).collect()} == {"x"} and "a.b" in EXTRA
    assert mixing.mix(nothing).count() == 0


def test_equal_rows_are_taken_at_the_rate(spark):
    rows = [(1, "one two three four five", "en", "a", 0)] * 400 + [(i, "w w w w w", "en", "b", 0) for i in range(2, 402)]
    rows += [(None, "w w w w w", "en", None, 0)] * 300
    for parts in (1, 7):
        docs = frame(spark, rows).repartition(parts)
        plan = mixing.plan_mix(docs).collect()
        assert len(plan) == len(rows)
        for source, rel in (("a", 0.02), (None, 0.02), ("b", 0.2)):
            mine = [r for r in plan if r["source"] == source]
            assert sum(r["size"] * r["copies"] for r in mine) == pytest.approx(mine[0]["target"], rel=rel), source
        mixed = Counter(r["source"] for r in mixing.mix(docs).collect())
        assert mixed == Counter(r["source"] for r in plan for _ in range(r["copies"]))


def test_equal_rows_are_numbered_across_partitions(spark):
    rows = spark.range(100).selectExpr("id % 3 AS key", "id").repartition(6, "id").select(
        "key", F.monotonically_increasing_id().alias("row")
    )
    held = {r["row"]: r["key"] for r in rows.collect()}
    numbers = {}
    for r in mixing.number_equal(rows, "key", "row").collect():
        numbers.setdefault(held[r["_row"]], []).append(r["nth"])
    assert {k: sorted(v) for k, v in numbers.items()} == {k: list(range(len(range(k, 100, 3)))) for k in range(3)}
