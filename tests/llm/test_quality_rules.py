from __future__ import annotations

import re

from pyspark.sql import functions as F

from sluice.llm import quality_rules
from sluice.llm.common import words
from tests.llm.conftest import ODD, SENTENCE, frame

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen: dict = {}
    for x in wins:
        seen[x] = seen.get(x, 0) + 1
    hit = {p for i, x in enumerate(wins) if seen[x] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(hit),
    )


def test_base_counts_match_brute_force(spark, odd):
    more = [
        "a b c d e f g h " * 5,
        " ".join("abcdefghij" * 3),
        "x " * 200 + "y " * 3,
        "one two\n\none two\n \none two ",
        "#*$%&|<>   \x85 \xa0w",
        "a b c d e f g h z a b c d e f g h i q b c d e f g h i",
    ]
    docs = odd.unionByName(frame(spark, [(100 + i, t, "en", "s9", 0) for i, t in enumerate(more)]))
    got = quality_rules.quality_rules(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    have = sorted((str(r["doc_id"]), tuple(r[n] for n in names)) for r in got)
    want = sorted((str(d), base(t)) for d, t in [(x[0], x[1]) for x in ODD] + [(100 + i, t) for i, t in enumerate(more)])
    assert have == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_lines_above_the_limit_deplete_documents(spark):
    own = lambda i: " ".join(f"own{i}w{j}" for j in range(30))
    common = SENTENCE + " and more words to be a long line of a menu"
    rows = [(i, common + "\n" + own(i), "en", "h", 0) for i in range(30)]
    rows += [(100 + i, own(i) + "\n" + common.upper() + " \t", "en", "h", 0) for i in range(5)]
    rows += [(200, common + "\nfew words", "en", "h", 0), (201, common, "en", "other", 0)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(frame(spark, rows)).collect()}
    n = len(common.split())
    assert all(got[r[0]]["n_removed"] == n and got[r[0]]["kept"] for r in rows[:35])
    assert not got[200]["kept"] and not got[200]["base_failed"]
    assert got[201]["n_removed"] == 0 and got[201]["kept"]


def test_the_limit_is_bounded_in_a_large_host(spark):
    menu = SENTENCE + " and more words of a menu"
    rows = [(i, (menu + "\n" if i < 12 else "") + f"short {i}", "en", "h", 0) for i in range(100)]
    docs = frame(spark, rows)

    def rejected(**limits):
        got = quality_rules.quality_rules(docs, **limits).collect()
        return {r["doc_id"] for r in got if not r["kept"] and not r["base_failed"]}

    assert rejected(max_share=0.5) == set()
    assert rejected(max_share=0.5, max_docs=11) == set(range(12))
    assert rejected(max_share=0.1) == set(range(12))
    assert rejected(min_docs=12, max_share=0.1) == set()


def test_empty_table(nothing):
    assert quality_rules.quality_rules(nothing).count() == 0


def test_words_part_at_the_six_blanks_only(spark):
    df = spark.createDataFrame([("a b c d\x0be\x1cf",)], "t string").select(words(F.col("t")).alias("w"))
    assert df.first()["w"] == ["a b c", "d", "e\x1cf"]
