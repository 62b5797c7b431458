"""License scans against a word-by-word version, and the expression parser."""

from __future__ import annotations

import random
import re

import pytest

from sluice.llm import licenses, queries
from tests.llm.conftest import ODD, frame

BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for i in range(len(words)) for p, label in BASE.items() if tuple(words[i : i + len(p)]) == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def pieces(rng):
    some = [
        "MIT License", "mit-license", "the Apache\tLicense", "GNU General Public License", "general public", "license mit license",
        "Lesser General Public License", "SPDX-License-Identifier: MIT OR (Apache-2.0 AND gpl-2.0+)", "é", "\x7f", "x mit license",
        "SPDX-License-Identifier:", "licensed under CC BY-NC 4.0.", "mitlicense", "ünder\nmit\nlicense", "0", "All rights reserved",
    ]
    return rng.choice([" ", ". ", "\n", "-"]).join(rng.choice(some) for _ in range(rng.randrange(12)))


def test_base_columns_match_a_word_by_word_scan(spark):
    rng = random.Random(3)
    rows = [(i, pieces(rng), "en", "s", 1) for i in range(400)] + ODD
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted([str((r[0], r[1], *brute(r[1]))) for r in rows])
    assert want == sorted(
        str((r["doc"]["doc_id"], r["doc"]["text"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))
        for r in got
    )
    for r in got:
        assert set(r["base_labels"]) <= set(r["labels"]) and r["labels"] == sorted(set(r["labels"]))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


@pytest.mark.parametrize(
    "text, labels, score, expressions",
    [
        ("// SPDX-License-Identifier: MIT OR GPL-3.0-only\nint x;", ["gpl", "mit"], 0.9, ["mit or gpl-3.0-only"]),
        ("SPDX-License-Identifier: MIT AND GPL-3.0-only */", ["gpl", "mit"], 0.3, ["mit and gpl-3.0-only"]),
        ("spdx-license-identifier: GPL-2.0 WITH Classpath-exception-2.0.", ["gpl"], 0.65, ["gpl-2.0 with classpath-exception-2.0"]),
        ("SPDX-License-Identifier: (MIT OR X-1", [], 0.0, []),
        ("SPDX-License-Identifier: MIT is a tag", ["mit"], 0.9, ["mit"]),
        ("SPDX-License-Identifier: Foo-1.0", ["other"], 0.2, ["foo-1.0"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"], 0.1, []),
        ("GNU Lesser General Public License", ["gpl", "lgpl"], 0.5, []),
        ("SPDX-License-Identifier: " + "(" * 3 + "MIT" + ")" * 3 + "\nApache License", ["apache", "mit"], 0.9, ["(((mit)))"]),
        ("nothing here", [], 0.0, []),
    ],
)
def test_tags_and_notices(text, labels, score, expressions):
    got = licenses.scan(text.encode())
    assert (got[5], pytest.approx(score), got[7]) == (labels, got[6], expressions)


def tree(rng, depth=0):
    """A random expression, fully known: (text, freedom, how tightly its operator binds)."""
    if depth > 3 or rng.random() < 0.3:
        name = rng.choice(["MIT", "GPL-3.0-only", "MPL-2.0", "CC-BY-NC-4.0", "Foo"])
        return name, licenses.FREEDOM.get(licenses.family(name.lower()), licenses.UNKNOWN), 9
    op = rng.choice(["or", "and"])
    (a, fa, ba), (b, fb, bb) = tree(rng, depth + 1), tree(rng, depth + 1)
    own = licenses.BINDS[op]
    a = f"({a})" if ba < own or rng.random() < 0.2 else a
    b = f"( {b} )" if bb < own or rng.random() < 0.2 else b
    return f"{a} {rng.choice([op, op.upper()])} {b}", (max if op == "or" else min)(fa, fb), own


def test_expressions_are_evaluated_as_their_trees():
    rng = random.Random(5)
    for _ in range(500):
        text, free, _ = tree(rng)
        assert licenses.evaluate(text)[1] == free, text
        assert licenses.leading_expression(text.lower() + " , and more") == text.lower()


@pytest.mark.parametrize("bad", ["", "and", "mit or", "(mit", "mit)", "mit mit", "mit (or) gpl", "or mit"])
def test_expressions_that_cannot_be_read(bad):
    with pytest.raises(licenses.ExpressionError):
        licenses.postfix(bad)


def test_a_long_line_after_a_tag_is_read_whole():
    text = "SPDX-License-Identifier: " + " AND ".join(["MIT"] * 50_000) + " OR GPL-2.0"
    got = licenses.scan(text.encode())
    assert got[5] == ["gpl", "mit"] and got[6] == 0.9


def test_the_query_joins_labels(spark, tmp_path):
    rows = [(1, "MIT License. Apache License. SPDX-License-Identifier: Zlib"), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    a, b = queries.QUERIES["op13_license_scan"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert (a["base_labels"], a["labels"], a["n_base"], a["last_word"]) == ("apache,mit", "apache,mit,zlib", 2, 2)
    assert (b["n_words"], b["labels"], b["score"], b["first_word"]) == (0, "", 0.0, None)
