"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target share of them, and a
document is emitted ``floor(rate)`` times plus one hash-seeded Bernoulli copy
with probability ``rate - floor(rate)``, where ``rate`` is the target of its
source over that source's tokens.

Defined cases
-------------
* null text: size 0, never fails; a document of size 0 counts no tokens.
* null source: one source of its own, ranked last.
* null ``doc_id``: seeded by its text, like any other.
* repeated rows: rows of one id, source and text are numbered, and each draws the
  first one's number moved on by the golden ratio for each row before it. So of
  k equal rows a share within a copy or two of the rate is taken; which of them
  gets which number may depend on the partitions, and does not matter.
* empty table: no rows. All sizes 0: targets 0, nothing is taken.
* extra columns: carried through ``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import global_rank, ref, stage_table, text_of, words

# Defaults of the operator: weights dealt to the sources in order, the most a
# source may be repeated, and the seed of the copies' draw.
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix-1"

# Fixed value: the step between the draws of equal rows; its multiples are spread evenly over [0, 1).
GOLDEN = 0.6180339887498949


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the document and the seed: 52 bits of an MD5."""
    key = F.concat_ws("\x1f", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text.cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def number_equal(rows: DataFrame, key: str, row: str) -> DataFrame:
    """_row, nth (from 0) of the rows whose key is not theirs alone.

    ``row`` is a ``monotonically_increasing_id``, so its high bits are the row's
    partition. Rows are numbered inside their partition, and partitions of a
    key by the counts before them: a key on a third of all rows is split.
    """
    keys = rows.select(F.col(key).alias("_key"), F.col(row).alias("_row"), F.shiftright(row, 33).alias("_part"))
    many = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_key").alias("_many"))
    found = keys.join(many, F.col("_key") == F.col("_many"), "left_semi")
    here = found.withColumn("_here", F.row_number().over(Window.partitionBy("_key", "_part").orderBy("_row")))
    counts = found.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = counts.select(
        F.col("_key").alias("_k"), F.col("_part").alias("_p"), (F.sum("_n").over(so_far) - F.col("_n")).alias("_before")
    )
    return here.join(before, (F.col("_key") == F.col("_k")) & (F.col("_part") == F.col("_p"))).select(
        "_row", (F.col("_before") + F.col("_here") - 1).alias("nth")
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target for each source of ``sizes`` (source, size).

    All tokens are shared by weight; a source stops at ``max_repeats`` times its
    size and its excess is shared again, until none is above. Each round is one
    small aggregate over the sources, and a round without a new full source ends
    it, so the loop runs at most once per distinct level of fullness.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = global_rank(sources, [F.col("source").isNull(), F.col("source")], "_rank", "mix")
    dealt = F.array(*[F.lit(int(w)) for w in weights])
    weighed = stage_table(
        ranked.select(
            "source",
            "source_size",
            F.get(dealt, ((F.col("_rank") - 1) % len(weights)).cast("int")).cast("long").alias("weight"),
            (F.col("source_size") * max_repeats).alias("ceiling"),
        ),
        "mix-weights",
    )
    left, weight = 0, 1  # the level: target = weight of the source * left / weight, unless full

    def is_full() -> Column:
        return F.col("ceiling").cast("double") * float(weight) < F.col("weight").cast("double") * float(left)

    full, level = F.lit(False), None
    while level != (left, weight):
        level = (left, weight)
        sums = weighed.agg(
            F.sum("source_size").alias("tokens"),
            F.sum(F.when(full, F.col("ceiling"))).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if not sums["weight"]:
            break
        left, weight = int(sums["tokens"] or 0) - int(sums["held"] or 0), int(sums["weight"])
        full = is_full()
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(weight))
    return weighed.select(
        "source", "source_size", F.when(full, F.col("ceiling").cast("double")).otherwise(share).alias("target")
    )


def plan_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies per document.

    ``carry`` names further columns of ``docs`` to keep beside them as the
    struct ``carried``. The text is read once: sizes and draws go to a stage
    table, and both the per-source sums and the copies come from that.
    """
    text = text_of()
    same = F.concat_ws("\x1f", ref("doc_id").cast("string"), F.md5(text.cast("binary")), F.md5(ref("source").cast("binary")))
    kept = F.struct(*[ref(c) for c in carry]).alias("carried") if carry else None
    sizes = stage_table(
        docs.select(
            ref("doc_id").alias("doc_id"),
            ref("source").cast("string").alias("source"),
            F.size(words(text)).cast("long").alias("size"),
            draw(ref("doc_id"), text, seed).alias("u"),
            F.xxhash64(same, ref("doc_id").isNull(), ref("source").isNull()).alias("key"),
            F.monotonically_increasing_id().alias("row"),
            *([kept] if carry else []),
        ),
        "mix-sizes",
    )
    numbers = stage_table(number_equal(sizes, "key", "row"), "mix-equal")
    sizes = sizes.join(numbers, F.col("row") == F.col("_row"), "left").drop("_row", "row", "key")
    moved = F.col("u") + F.coalesce("nth", F.lit(0)).cast("double") * F.lit(GOLDEN)
    sizes = sizes.withColumn("u", moved - F.floor(moved).cast("double")).drop("nth")
    targets = source_targets(sizes.select("source", "size"), weights, max_repeats).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sizes.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    whole = F.floor(rate)
    copies = F.least(whole + (F.col("u") < rate - whole).cast("long"), F.lit(max_repeats).cast("long"))
    return joined.withColumn("copies", copies).drop("u")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mixed documents: the columns of ``docs``, one row per copy."""
    plan = plan_mix(docs, weights, max_repeats, seed, carry=tuple(docs.columns))
    emitted = plan.where(F.col("copies") > 0).select(
        "carried", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    )
    return emitted.select(*[F.col("carried").getField(c).alias(c) for c in docs.columns])
