"""License scans: tags and notice phrases by one automaton, expressions by a shunting yard.

Every text goes once through two Aho-Corasick automata. One runs over its words
(lower-cased, parted by ASCII characters that are neither letters nor digits)
and finds notice phrases as runs of whole words. The other runs over the text
itself and finds identifier tags (``SPDX-License-Identifier:``); what follows a
tag in its line is a licence expression (``MIT OR (Apache-2.0 WITH
LLVM-exception)``), which a shunting-yard parser turns into postfix form and
evaluates: ``or`` gives the freer of two licences, ``and`` the stricter,
``with`` loosens a licence by its exception.

The score says how freely what was found lets the text be used: 1 for the
public domain, 0 where nothing is found; of several statements the strictest
counts, as all of them hold.

A text needs no other text, so the work is one pass without a shuffle. A null
or empty text has no words and nothing found; repeated rows are scanned each
for itself; an empty table gives no rows; other columns are carried in ``doc``
whatever their names.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ref, text_of

# The phrases of the base scan.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further notices, as words, and their labels.
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc",
    "cc by nc nd": "cc-by-nc",
    "cc0": "cc0",
    "free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}

# Tags that a licence expression follows.
TAGS = ["spdx-license-identifier:", "license-expression:"]

# Beginnings of licence identifiers and their labels; the longest that fits counts.
FAMILIES = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "mpl": "mpl", "epl": "epl",
    "bsd": "bsd", "0bsd": "bsd", "isc": "isc", "bsl": "bsl", "unlicense": "unlicense", "zlib": "zlib",
    "cc0": "cc0", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
}

# How freely a text under a label may be used.
FREEDOM = {
    "cc0": 1.0, "unlicense": 1.0, "mit": 0.9, "bsd": 0.9, "isc": 0.9, "zlib": 0.9, "bsl": 0.9, "apache": 0.9,
    "cc-by": 0.8, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.4, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2,
    "cc-by-nc": 0.1, "proprietary": 0.05,
}

OTHER = "other"  # a well-formed identifier of no family
UNKNOWN = 0.2  # freedom of such an identifier

# How tightly the operators of an expression bind.
BINDS = {"or": 1, "and": 2, "with": 3}

_LABELS = {**NOTICES, **BASE_PHRASES}
_TOKEN = re.compile(r"[()]|[a-z0-9](?:[a-z0-9.+:-]*[a-z0-9+])?")
# Bytes that part words, as blanks: ASCII other than digits and letters.
_PART = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


class ExpressionError(ValueError):
    """A licence expression that cannot be read."""


def postfix(expression: str) -> list[str]:
    """The lower-cased tokens of a licence expression in postfix order (shunting yard)."""
    out: list[str] = []
    waiting: list[str] = []
    operand_due = True
    for token in _TOKEN.findall(expression.lower()):
        if token == "(":
            if not operand_due:
                raise ExpressionError("an operator is missing")
            waiting.append(token)
        elif token == ")":
            if operand_due:
                raise ExpressionError("a licence is missing")
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ExpressionError("an opening bracket is missing")
            waiting.pop()
        elif token in BINDS:
            if operand_due:
                raise ExpressionError("a licence is missing")
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand_due = True
        else:
            if not operand_due:
                raise ExpressionError("an operator is missing")
            out.append(token)
            operand_due = False
    if operand_due:
        raise ExpressionError("a licence is missing")
    while waiting:
        if waiting[-1] == "(":
            raise ExpressionError("a closing bracket is missing")
        out.append(waiting.pop())
    return out


def family(identifier: str) -> str:
    """Label of a licence identifier: the family of its longest known beginning."""
    parts = identifier.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        label = FAMILIES.get("-".join(parts[:n]))
        if label is not None:
            return label
    return OTHER


def evaluate(expression: str) -> tuple[frozenset[str], float]:
    """Labels named by a licence expression, and how freely it lets the text be used.

    ``or`` leaves the choice to the user, so the freer side counts; ``and``
    binds the user to both; an exception moves a licence half the way to 1.
    """
    stack: list[tuple[frozenset[str], float]] = []
    for token in postfix(expression):
        if token not in BINDS:
            label = family(token)
            stack.append((frozenset([label]), FREEDOM.get(label, UNKNOWN)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left[0], (left[1] + 1) / 2))
        else:
            stack.append((left[0] | right[0], (max if token == "or" else min)(left[1], right[1])))
    return stack[0]


def leading_expression(line: str) -> str:
    """The longest beginning of a lower-cased line that reads as a licence expression; empty if none does."""
    depth = whole = end = 0
    operand_due = True
    for token in _TOKEN.finditer(line):
        if line[end : token.start()].strip():
            break  # something that is no token stands between
        word = token.group()
        if word == "(" and operand_due:
            depth += 1
        elif word == ")" and not operand_due and depth:
            depth -= 1
        elif word in BINDS and not operand_due:
            operand_due = True
        elif word not in BINDS and word not in "()" and operand_due:
            operand_due = False
        else:
            break
        end = token.end()
        if not operand_due and not depth:
            whole = end
    return line[:whole]


@cache
def _automata():
    phrases = ahocorasick.Automaton()
    for phrase in _LABELS:
        phrases.add_word(f" {phrase} ", phrase)
    phrases.make_automaton()
    tags = ahocorasick.Automaton()
    for tag in TAGS:
        tags.add_word(tag, tag)
    tags.make_automaton()
    return phrases, tags


def _statements(matches: list[tuple[int, int, str]]) -> list[str]:
    """The phrases of matches (start, stop, phrase) that no longer match holds: "cc by nc" is not "cc by"."""
    out, reached = [], -1
    for _start, stop, phrase in sorted(matches, key=lambda m: (m[0], -m[1])):
        if stop > reached:
            out.append(phrase)
            reached = stop
    return out


def scan(text: bytes) -> tuple:
    """n_words, places of base phrases, their smallest and largest start, base labels, all labels, score, expressions."""
    phrases, tags = _automata()
    lowered = text.lower()  # of bytes: A-Z only
    cut = lowered.translate(_PART).split()
    joined = f" {b' '.join(cut).decode('utf-8', 'replace')} "
    matches: list[tuple[int, int, str]] = []
    seen = blanks = 0
    for end, phrase in phrases.iter(joined):
        # ``end`` is the blank after the phrase; as many blanks stand before it as words.
        blanks += joined.count(" ", seen, end)
        seen = end
        matches.append((blanks - phrase.count(" ") - 1, blanks, phrase))
    base = [(start, BASE_PHRASES[phrase]) for start, _stop, phrase in matches if phrase in BASE_PHRASES]
    base_labels = {label for _start, label in base}
    labels = {_LABELS[phrase] for phrase in _statements(matches)}
    freedoms = [FREEDOM[label] for label in labels]
    expressions: list[str] = []
    plain = lowered.decode("utf-8", "replace")
    for end, _tag in tags.iter(plain):
        stop = plain.find("\n", end)
        expression = leading_expression(plain[end + 1 : stop if stop >= 0 else len(plain)])
        if expression:
            named, free = evaluate(expression)
            expressions.append(" ".join(expression.split()))
            labels |= named
            freedoms.append(free)
    return (
        len(cut),
        len(base),
        min((start for start, _ in base), default=None),
        max((start for start, _ in base), default=None),
        sorted(base_labels),
        sorted(labels | base_labels),
        min(freedoms, default=0.0),
        expressions,
    )


_SCANNED = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
    "score double, expressions array<string>"
)
_NAMES = [c.split()[0] for c in _SCANNED.split(", ")]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc (struct of the columns of ``docs``) and what its text says of licences.

    n_words; n_base, first_word, last_word: places of base phrases, the
    smallest and the largest of their first words (null without any);
    base_labels, labels (sorted); score; expressions (in order of their tags).
    """

    @F.pandas_udf(_SCANNED)
    def found(texts: pd.Series) -> pd.DataFrame:
        frame = pd.DataFrame([scan(t) for t in texts], columns=_NAMES)
        for name in ("first_word", "last_word"):
            frame[name] = frame[name].astype("Int64")
        return frame

    return docs.select(
        F.struct(*[ref(c) for c in docs.columns]).alias("doc"), found(text_of().cast("binary")).alias("found")
    ).select("doc", "found.*")
