"""The filter audit against a brute-force version, with files that come in any order and in several runs."""

from __future__ import annotations

import random
import re
from itertools import permutations

from sluice.llm import filter_audit
from sluice.session import scratch_path
from tests.llm.conftest import ODD, frame


def brute(rows, labels):
    good = {d for d, q, _t in labels if q == 1}
    toxic = {d for d, _q, t in labels if t == 1}
    docs = []
    for doc_id, text, _lang, source, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [r[0] for r in rows if (r[1] or "") == text and r[0] is not None]
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": doc_id is not None and min(same) < doc_id,
        }
        docs.append((source or "", {f for f in fails if fails[f]}, doc_id in good and doc_id is not None, doc_id in toxic and doc_id is not None))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, start=1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                failing = [d for d in own if f in d[1]]
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    len(failing) - len(gone),
                    sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone),
                    sum(d[3] for d in gone),
                    f,
                ]
        for (p, _o, _s), row in out.items():
            if p == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def found(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["a", "B", "ccc", "d#", "EE", "fé", f"w{i}"]) for i in range(rng.choice([10, 49, 50, 90]))) for _ in range(25)]
    texts += [" ".join(f"w{i}" for i in range(60)), "", None]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), "en", rng.choice(["s1", "s1", "s2", None]), 1) for _ in range(n)]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in range(0, 40, 2)] + [(0, 1, 1), (None, 1, 1)]
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_files_in_any_order_and_a_later_run_match_brute_force(spark):
    rows, labels = corpus(4, 160)
    path, folder = scratch_path(spark, "audit-docs"), scratch_path(spark, "audit-test")
    # Large ids first, so that smaller ones retract earlier masks; a file per sixteenth.
    rows.sort(key=lambda r: -(r[0] if r[0] is not None else 20))
    for i in range(0, 120, 10):
        frame(spark, rows[i : i + 10]).coalesce(1).write.mode("append").parquet(path)
    got = filter_audit.audit_filters(spark, path, label_frame(spark, labels), folder)
    assert found(got) == brute(rows[:120], labels)
    frame(spark, rows[120:]).coalesce(2).write.mode("append").parquet(path)
    again = filter_audit.audit_filters(spark, path, label_frame(spark, labels), folder)
    assert found(again) == brute(rows, labels)
    # Nothing new: nothing is counted twice.
    assert found(filter_audit.audit_filters(spark, path, label_frame(spark, labels), folder)) == brute(rows, labels)


def test_a_batch_that_is_repeated_counts_once(spark):
    rows, labels = corpus(5, 60)
    path, folder = scratch_path(spark, "audit-docs"), scratch_path(spark, "audit-test")
    frame(spark, rows).repartition(4).write.parquet(path)
    want = brute(rows, labels)
    assert found(filter_audit.audit_filters(spark, path, label_frame(spark, labels), folder)) == want
    # As if the driver had been lost after the last batch was written, before it was committed.
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    commits = fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/checkpoint/commits"))
    last = max((c.getPath() for c in commits if c.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
    assert int(last.getName()) > 0 and fs.delete(last, False)
    assert found(filter_audit.audit_filters(spark, path, label_frame(spark, labels), folder)) == want


def test_odd_rows_one_file_and_no_documents(spark, odd_labels, no_labels):
    labels = [tuple(r) for r in odd_labels.collect()]
    path = scratch_path(spark, "audit-odd")
    frame(spark, ODD).coalesce(1).write.parquet(path)
    name = next(f for f in spark.read.parquet(path).inputFiles())
    assert found(filter_audit.audit_filters(spark, name, odd_labels)) == brute(ODD, labels)
    assert found(filter_audit.audit_filters(spark, path, no_labels)) == brute(ODD, [])
    none = scratch_path(spark, "audit-none")
    frame(spark, []).write.parquet(none)
    assert found(filter_audit.audit_filters(spark, none, odd_labels)) == {}


def test_tasks_combine_copies_before_the_shuffle(spark):
    rows = [(i, "same text", "en", "s1", 1) for i in range(3000)]
    path = scratch_path(spark, "audit-hot")
    frame(spark, rows).repartition(3).write.parquet(path)
    got = found(filter_audit.audit_filters(spark, path, label_frame(spark, [])))
    assert got["s1", "EABCD", 1][:2] == (1, 2999) and got["s1", "AEBCD", 1][:2] == (0, 3000)
