from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import line_dedup
from sluice.llm.line_dedup import CuckooFilter
from tests.llm.conftest import ODD, SCHEMA, SENTENCE, frame

BLANKS = " \t\n\x0b\x0c\r"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line: str) -> str:
    return line.strip(BLANKS).translate(UPPER)


def brute(rows):
    held = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(d)
    last = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in held.items() if len(v) >= 3}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if key(x) not in last or last[key(x)] == d]
        out.append((str(d), len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


def result(df):
    return sorted((str(r["doc"]["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect())


def test_matches_brute_force_with_odd_rows(spark, odd, nothing):
    more = [(20 + i, f"{SENTENCE.upper()} \n unique line number {i} of these\r\nÉTÉ été ÉTÉ été ÉTÉ été\n\n", "en", "s", 0) for i in range(5)]
    got = line_dedup.dedup_lines(odd.unionByName(frame(spark, more)))
    assert result(got) == brute([(r[0], r[1]) for r in ODD + more])
    plain = line_dedup.without_repeated_lines(odd)
    assert plain.columns == SCHEMA.names and {r["a.b"] for r in plain.collect()} == {"x"}
    assert line_dedup.dedup_lines(nothing).count() == 0


def snapshot(state):
    counts = {(bytes(r["digest"]), r["n_docs"], r["last_doc"]) for r in state.counts.collect()}
    return counts, {(bytes(r["digest"]), r["doc_id"]) for r in state.postings.collect()}


def test_deleting_a_batch_gives_back_the_state_before_it(spark):
    line = "a line that is long enough number {}"
    first = frame(spark, [(i, "\n".join(line.format(j) for j in range(i, i + 4)), "en", "s", 0) for i in range(30)])
    second = frame(spark, [(100 + i, "\n".join(line.format(3 * j) for j in range(i, i + 5)), "en", "s", 0) for i in range(10)])
    empty = line_dedup.empty_state(spark, 4)
    one = line_dedup.insert(empty, first)
    both = line_dedup.insert(one, second)
    assert snapshot(line_dedup.insert(both, second)) == snapshot(both)
    back = line_dedup.delete(both, second)
    assert snapshot(back) == snapshot(one) != snapshot(both)
    # Filters know every counted key and, but for chance, none of the deleted ones.
    cells = {r["shard"]: CuckooFilter.from_bytes(bytes(r["cells"])) for r in back.filters.collect()}
    asked = lambda rows: [bool(cells[s].may_hold(np.frombuffer(d[:8], np.uint64))[0]) for s, d in rows]
    kept = {(r["shard"], bytes(r["digest"])) for r in back.counts.collect()}
    gone = {(r["shard"], bytes(r["digest"])) for r in both.counts.collect()} - kept
    assert all(asked(kept)) and gone and sum(asked(gone)) <= 1
    assert snapshot(line_dedup.delete(back, first)) == (set(), set())
    assert snapshot(line_dedup.insert(line_dedup.empty_state(spark, 4), first.unionByName(second))) == snapshot(both)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 10**6))
def test_cuckoo_filter_holds_what_it_was_given(n, seed):
    rng = np.random.default_rng(seed)
    hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    made = CuckooFilter.build(hashes)
    assert made.may_hold(hashes).all()
    assert CuckooFilter.from_bytes(made.to_bytes()).may_hold(hashes).all()
    gone, kept = hashes[::2], hashes[1::2]
    made.delete(gone)
    assert made.may_hold(kept).all()
    assert (made.cells != 0).sum() == len(kept)
    others = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    assert made.may_hold(others).mean() < 0.01


def test_digest_in_python_equals_the_one_in_spark(spark):
    text = "\x0bÉtÉ with a Long enough line, ÀÉ \t"
    rows = line_dedup.key_postings(frame(spark, [(1, text, "", "", 0)]), 1).collect()
    want = hashlib.sha256(text.encode().strip(BLANKS.encode()).lower()).digest()[:16]
    assert [bytes(r["digest"]) for r in rows] == [want]


def test_many_rows_without_an_id_are_one_document_each_losing_its_own_lines(spark):
    lines = [f"a line that is long enough number {i}" for i in range(12)]
    rows = [(None, "\n".join(lines[i % 10 : i % 10 + 3]), "en", "s", 0) for i in range(200)]
    rows += [(i, "\n".join([lines[i], lines[i + 1], f"own line of document number {i}"]), "en", "s", 0) for i in range(11)]
    got = line_dedup.dedup_lines(frame(spark, rows))
    assert result(got) == brute([(r[0], r[1]) for r in rows])
