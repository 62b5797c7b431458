"""Quality rules: cross-document line frequency.

Lines are normalised (A-Z lower-cased, blanks at both ends stripped, inner runs
of blanks made one space) and hashed; for each host (``source``) the distinct
documents holding a line are counted; lines above the host's limit are removed;
a document that loses too large a share of its words is rejected as depleted.
A document must also pass the base rules on its own text.

Defined cases
-------------
* null or empty text: no words and no lines; fails the base rules.
* null source: one host of its own. null ``doc_id``: one document id.
* repeated rows: one result row each; a line counts once per ``doc_id``.
* lines without a word are never counted or removed.
* empty table: no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import BLANKS, ascii_lower, let, ref, stage_table, text_of, total, words

# Defaults of the operator. A line is boilerplate of a host when it stands in more
# than MIN_DOCS of its documents, and in more than MAX_SHARE of them or MAX_DOCS:
# the limit does not rise without end with a large host.
MIN_DOCS = 10
MAX_SHARE = 0.02
MAX_DOCS = 1_000
MAX_REMOVED = 0.7  # a document losing more than this share of its words is depleted
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
SYMBOLS = "#*$%&|<>"


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words found twice or more in the text.

    Windows are hashed; equal hashes are found by sorting, and the union of the
    windows' spans is summed over the sorted starts, so a text of n words costs
    O(n log n). Texts without an equal pair stop after one distinct count.
    """

    def spans(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            def start(e: Column, k: Column) -> Column:
                same = (F.get(s, k - 1).getField("h") == e.getField("h")) | (
                    F.get(s, k + 1).getField("h") == e.getField("h")
                )
                return F.when(same, e.getField("i"))

            return F.array_sort(F.array_compact(F.transform(s, start)))

        def covered(p: Column) -> Column:
            return total(
                F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
            )

        return let(let(ordered, starts), covered)

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))
        checked = let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(spans(h)),
        )
        return F.when(F.size(w) < window, F.lit(0).cast("long")).otherwise(checked)

    return let(tokens, of)


def normalised_line(line: Column) -> Column:
    return ascii_lower(F.array_join(words(line), " "))


def measure(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and its lines as (hash, words), from one scan."""
    text = F.col("text")
    rows = docs.select(
        ref("doc_id").alias("doc_id"), ref("source").cast("string").alias("host"), text_of().alias("text")
    )
    worded = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)

    def line(x: Column) -> Column:
        return let(words(x), lambda w: F.struct(
            F.xxhash64(ascii_lower(F.array_join(w, " "))).alias("line"), F.size(w).alias("n")
        ))

    def counts(lines: Column) -> Column:
        return F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.transform(lines, line).alias("lines"),
        )

    return rows.select(
        "doc_id",
        "host",
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")
        )).alias("w"),
        let(worded, counts).alias("l"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def boilerplate(
    lines: DataFrame, docs_per_host: DataFrame, min_docs: int, max_share: float, max_docs: int = MAX_DOCS
) -> DataFrame:
    """host, line for the lines above their host's limit. ``lines``: host, doc_id, line."""
    held = (
        lines.dropDuplicates(["host", "line", "doc_id"])
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") > min_docs)
    )
    sizes = docs_per_host.withColumnRenamed("host", "_host")
    return held.join(sizes, F.col("host").eqNullSafe(F.col("_host"))).where(
        (F.col("n_docs") > F.col("host_docs") * F.lit(max_share)) | (F.col("n_docs") > max_docs)
    ).select("host", "line")


def quality_rules(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    max_removed: float = MAX_REMOVED,
    max_docs: int = MAX_DOCS,
) -> DataFrame:
    """Per document: the base counts, ``n_removed`` words in boilerplate lines, ``base_failed``, ``kept``.

    Per host and line the counts are combined before the shuffle, so a line on
    a third of all documents is a few rows per task; the join back of the lines
    is an equi-join whose hot keys adaptive execution splits.
    """
    rows = stage_table(measure(docs), "quality-rows")
    lines = rows.select("row_id", "doc_id", "host", F.explode("l.lines").alias("x")).select(
        "row_id", "doc_id", "host", "x.line", "x.n"
    )
    hosts = rows.select("host", "doc_id").dropDuplicates().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    common = boilerplate(lines.select("host", "doc_id", "line"), hosts, min_docs, max_share, max_docs).select(
        F.col("host").alias("_host"), F.col("line").alias("_line")
    )
    removed = (
        lines.join(common, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
        .groupBy("row_id")
        .agg(F.sum("n").alias("n_removed"))
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    depleted = F.col("n_removed") > F.col("n_words") * F.lit(max_removed)
    return (
        rows.join(removed, "row_id", "left")
        .select(
            "doc_id",
            "w.n_words",
            "word_chars",
            "n_symbols",
            "l.n_dup_lines",
            "w.n_repeat_words",
            F.coalesce(F.col("n_removed"), F.lit(0)).cast("long").alias("n_removed"),
        )
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )
