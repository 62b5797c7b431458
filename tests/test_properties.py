"""Randomized properties (hypothesis): inference and batching laws on generated records."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import BATCH_TIME, new_sink, records
from sluice.operators import infer, route
from sluice.sources.envelope import normalise

FIELDS = ["a", "b", "c", "d"]
# Each field keeps one JSON kind across records (the agreeing-types case).
KINDS = {
    "BIGINT": st.integers(min_value=-(2**62), max_value=2**62),
    "DOUBLE": st.floats(allow_nan=False, allow_infinity=False, width=64).filter(lambda x: x != int(x)),
    "STRING": st.text(max_size=6),
    "BOOLEAN": st.booleans(),
}
SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@st.composite
def typed_records(draw):
    kinds = {f: draw(st.sampled_from(sorted(KINDS))) for f in FIELDS}
    n = draw(st.integers(min_value=1, max_value=12))
    docs = []
    for _ in range(n):
        doc = {}
        for f in FIELDS:
            choice = draw(st.sampled_from(["value", "null", "absent"]))
            if choice == "value":
                doc[f] = draw(KINDS[kinds[f]])
            elif choice == "null":
                doc[f] = None
        docs.append(doc)
    return kinds, docs


def _inferred_types(spark, docs):
    rows = [("t", json.dumps(d), i) for i, d in enumerate(docs)]
    prepared = route.prepare(normalise(records(spark, rows)))
    got = infer.infer_schema(infer.observe_fields(prepared)).where("field IS NOT NULL").collect()
    return {r["field"]: r["data_type"] for r in got}


@SLOW
@given(typed_records(), st.randoms(use_true_random=False))
def test_inference_matches_value_kinds_in_any_order(spark, case, rnd):
    kinds, docs = case
    expected = {}
    for f in FIELDS:
        seen = [d[f] for d in docs if f in d]
        if seen:
            expected[f] = kinds[f] if any(v is not None for v in seen) else None
    assert _inferred_types(spark, docs) == expected
    shuffled = docs[:]
    rnd.shuffle(shuffled)
    assert _inferred_types(spark, shuffled) == expected


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(min_value=0, max_value=5), min_size=2, max_size=16),
    st.integers(min_value=2, max_value=3),
)
def test_k_batches_in_time_order_equal_one_batch(spark, keys, k):
    rows = [("t", json.dumps({"unique_id": key, "v": i}), i) for i, key in enumerate(keys)]
    one = new_sink(spark)
    one.process_batch(records(spark, rows), 0, "w", BATCH_TIME)
    many = new_sink(spark)
    size = -(-len(rows) // k)
    for b in range(k):
        part = rows[b * size : (b + 1) * size]
        if part:
            many.process_batch(records(spark, part), b, "w", BATCH_TIME)

    def state(sink):
        return sorted((r["unique_id"], r["v"], r["kafka_offset"]) for r in sink.read("t").collect())

    expected = sorted({key: (key, i, i) for i, key in enumerate(keys)}.values())
    assert state(one) == expected
    assert state(many) == expected
