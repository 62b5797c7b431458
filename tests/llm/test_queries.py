"""The registered queries and the pipeline over small tables on disk."""

from __future__ import annotations

import contextlib
import hashlib
import io
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sluice.llm import oracles, queries
from sluice.session import scratch_path
from tests.llm.test_classifiers import WORDS
from tests.llm.test_classifiers import corpus as toxic_corpus
from tests.llm.test_decontaminate import brute as brute_contaminated
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import water_fill
from tests.llm.test_simhash_ball import brute_print, brute_roots
from tests.oracle_compare import compare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, seed: int = 9) -> tuple[str, list, list, list]:
    """A folder of tables with copies, near copies, repeated lines, benchmark passages and toxic texts."""
    rng = random.Random(seed)
    rows, toxic = toxic_corpus(rng, 260)
    items = [(i, " ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(rng.choice([6, 15, 30])))) for i in range(12)]
    lines = [" ".join(rng.choice(WORDS) for _ in range(8)) for _ in range(6)]
    docs = []
    for i, (d, text, *_rest) in enumerate(rows):
        parts = text.split(" ")
        text = " ".join(parts[:30]) + "\n" + "\n".join(rng.sample(lines, rng.randrange(3))) + "\n" + " ".join(parts[30:])
        if i % 13 == 0:
            text += "\n" + rng.choice(items)[1].upper()
        docs.append((d, text, "en", f"s{rng.choice([0, 0, 0, 1, 2, 3])}"))
    for j in range(30):
        d, text, lang, source = docs[j * 3]
        docs.append((1000 + j, text if j % 2 else text + " more", lang, source))
        toxic.append(toxic[j * 3])
    docs += [(2000, None, None, None), (2001, "", "en", "s1")]
    docs = [(*r, len(r[1] or "")) for r in docs]
    labels = [(r[0], 1 - t, t) for r, t in zip(docs, toxic)]
    chats = [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["hi", "<|im_end|>", "a\\b[INST]", None])) for c in range(20) for t in range(c % 5 + 1)]
    path = scratch_path(spark, "llm-tables")
    for name, data, schema in (
        ("documents", docs, DOCS),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
        ("conversations", chats, "conv_id long, turn int, role string, text string"),
    ):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path, docs, items, toxic


@pytest.fixture(scope="module")
def made(spark):
    return tables(spark)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_sql_gives_the_same_rows(spark, made, name):
    path = made[0].removeprefix("file:")
    import duckdb

    def oracle(sf_dir, sql):
        con = duckdb.connect()
        for t in ("documents", "labels", "benchmark", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet/*.parquet')")
        rel = con.sql(sql)
        return rel.columns, rel.fetchall()

    from tests import oracle_compare

    kept, oracle_compare.oracle = oracle_compare.oracle, oracle
    try:
        ok, message = compare(spark, path, name, queries.QUERIES[name], oracles.ORACLES[name])
    finally:
        oracle_compare.oracle = kept
    assert ok, message


@pytest.mark.parametrize("name", ["op2_quality_rules", "op8_mix_sources", "op10_chat_format"])
def test_native_queries_stay_in_the_jvm(spark, made, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        queries.QUERIES[name](spark, made[0]).explain()
    assert not any(word in buf.getvalue() for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_the_entry_registers_every_operator_and_the_pipeline():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run
    assert "op2_quality_rules" in entry.oracle_sql() and "pipeline" not in entry.oracle_sql()


def test_every_query_returns_a_row_per_document(spark, made):
    path, docs, *_ = made
    for name in ("op1_lm_scoring", "op3_simhash", "op4_toxicity", "op6_quality_classifier"):
        rows = queries.QUERIES[name](spark, path).collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in docs), name


def draw(doc_id, text) -> float:
    key = f"mix-1\x1f{doc_id}\x1f{hashlib.md5((text or '').encode()).hexdigest()}"
    return int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52


def test_the_pipeline_matches_a_brute_force_version(spark, made):
    path, docs, items, toxic = made
    source = {d[0]: d[3] for d in docs}
    marked = {d[0] for d, t in zip(docs, toxic) if t}
    rows = [(d[0], d[1]) for d in docs if d[0] not in marked]
    rows = [(int(i), text) for i, _n, _d, text in brute_lines(rows)]
    prints = {i: brute_print(t) for i, t in rows}
    near = [(a, b) for a in prints for b in prints if b < a and bin(prints[a] ^ prints[b]).count("1") <= 2]
    roots = brute_roots(list(prints), near)
    rows = [(i, t) for i, t in rows if roots[i] == i]
    dirty = {int(i) for i, _n, hit, _ids in brute_contaminated(rows, items) if hit}
    assert marked and dirty and len(rows) < len(prints)
    rows = [(i, t) for i, t in rows if i not in dirty]
    sizes = {}
    for i, t in rows:
        sizes[source[i]] = sizes.get(source[i], 0) + len((t or "").encode().split())
    target = water_fill(sizes)
    want = []
    for i, t in rows:
        rate = target[source[i]] / sizes[source[i]] if sizes[source[i]] else 0
        want += [(i, t or "")] * min(3, int(rate) + (draw(i, t) < rate - int(rate)))
    got = corpus_pipeline.run(spark, path)
    assert got.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted((r["doc_id"], r["text"] or "") for r in got.collect()) == sorted(want)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got.collect())


def test_stages_take_and_return_documents(spark, made):
    path, docs, *_ = made
    frame = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, path)
        assert out.columns == frame.columns and out.count() == 0


@pytest.mark.parametrize("empty", ["labels", "benchmark", "both"])
def test_the_pipeline_without_labels_or_benchmark(spark, made, empty):
    path, docs, *_ = made
    none = scratch_path(spark, "llm-empty")
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{path}/{name}.parquet")
        if empty in (name, "both") and name != "documents":
            table = table.limit(0)
        table.coalesce(1).write.parquet(f"{none}/{name}.parquet")
    frame = spark.read.parquet(f"{none}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = sorted(d[0] for d in docs)

    def left(stage):
        return sorted(r["doc_id"] for r in stages[stage](spark, frame, none).collect())

    assert (left("toxicity") == ids) == (empty != "benchmark")
    assert (left("benchmark_decontamination") == ids) == (empty != "labels")


def test_the_pipeline_carries_odd_rows_and_other_columns(spark, odd, made):
    """Null ids and texts, repeated rows and clashing names through all stages."""
    path = scratch_path(spark, "llm-odd")
    rows = odd.collect()
    odd.coalesce(1).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{made[0]}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    got = corpus_pipeline.run(spark, path)
    assert got.columns == odd.columns
    out = got.collect()
    assert {r["a.b"] for r in out} == {"x"}
    texts = {r["text"] for r in rows}
    for r in out:
        assert r["n_chars"] == len(r["text"])
        assert any(set(r["text"].split("\n")) <= set((t or "").split("\n")) for t in texts)


def test_proximity_names_items_that_are_near_and_not_equal(spark, made):
    path, docs, items, _toxic = made
    exact = {r[0]: r[3] for r in brute_contaminated([(d[0], d[1]) for d in docs], items)}
    for r in queries.QUERIES["benchmark_proximity"](spark, path).collect():
        assert not set(r["near_items"].split(",")) & set(exact[str(r["doc_id"])])


def test_a_passage_is_listed_for_both_of_its_documents(spark):
    rng = random.Random(4)
    text = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(n)) for n in (30, 60, 80, 60)]
    rows = [(1, text[0] + " " + text[1]), (2, text[1] + " " + text[2]), (3, text[3]), (4, text[3]), (5, text[2][:200])]
    path = scratch_path(spark, "both-sides")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    found = queries.op9_passages(spark, path)
    got = {(r["doc_id"], r["other_id"]): (r["start"], r["n_words"], r["other_start"], r["other_words"], r["edits"]) for r in found.collect()}
    assert found.columns == ["doc_id", "other_id", "start", "n_words", "other_start", "other_words", "edits", "similarity"]
    assert got == {(1, 2): (30, 60, 0, 60, 0), (2, 1): (0, 60, 30, 60, 0), (3, 4): (0, 60, 0, 60, 0), (4, 3): (0, 60, 0, 60, 0)}
