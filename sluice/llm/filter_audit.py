"""Filter interaction audit: what each filter removes, in every order of the filters.

The documents come as a stream of files, taken in micro-batches until none is
left; files that come later are taken by the next run on the same folder. A
document's failures are a mask of one bit per filter. Four filters judge a text
by itself; the fifth, a text that a smaller id holds as well, needs state:

1. Before the shuffle each task counts its documents by part and mask, and keeps
   per text only those with the smallest id in the task; the others fail the
   fifth filter whatever comes. A hot text sends a few rows from each task.
2. For every text (128 bits of its SHA-256) the state holds the smallest id so
   far and how its documents were counted. When a smaller id comes, the earlier
   masks are retracted from the counters of their parts and counted anew with
   the bit of the fifth filter; a larger id is corrected at once. As a call per
   key costs milliseconds, some ``TEXTS_PER_STATE`` texts share a state.
3. The changes of a micro-batch are summed per part and mask and written to a
   folder named after the batch: a repeated batch overwrites its own, so that
   lost executors and restarts count nothing twice.

The counters have a row per part, mask and labels at most, however many
documents there are; all orders are computed from them.

Results for odd rows: a null text is empty and fails A only; a null id is
neither smaller nor larger than another, so it never fails E; rows that repeat
id and text are counted each, and none of them has a smaller id. Of repeated
labels of a document a mark that any row gives counts; null labels mark
nothing. A null source is the part with the empty name. No documents give no
rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sluice.llm.common import UPPER, ref, stage_table, text_of
from sluice.llm.packing import rows_of
from sluice.session import scratch_path

# The filters, their limits, and the characters that D looks for.
FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
MARKUP = re.compile(rb"[#$%&*|]")

REPEATED = 1 << FILTERS.index("E")
BATCHES = 4  # micro-batches that the files of a first run are dealt to
COMBINE_ROWS = 200_000  # rows that a task gathers before it combines them
TEXTS_PER_STATE = 256

_COUNTER = "part string, mask int, good boolean, toxic boolean, n long"
# A text's own counting, or (bucket SETTLED) counts that no other row can change.
_CHANGE = "bucket string, key string, least long, " + _COUNTER
_SETTLED = "~"
_UPPER = UPPER.encode()


def own_failures(text: bytes) -> int:
    """Mask of the filters A to D that a text fails."""
    found = text.split()  # of bytes: at the six ASCII blanks only
    upper = len(text) - len(text.translate(None, _UPPER))
    fails = (
        len(found) < MIN_WORDS,
        100 * len(set(found)) < MIN_DISTINCT_PERCENT * len(found),
        100 * upper > MAX_UPPER_PERCENT * len(text.decode("utf-8", "replace")),
        MARKUP.search(text) is not None,
    )
    return sum(1 << i for i, f in enumerate(fails) if f)


_JUDGED = "doc_id long, part string, key string, mask int"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's text replaced by its digest and its mask."""
    for batch in batches:
        keys, masks = [], []
        for (text,) in rows_of(batch, "text"):
            keys.append(hashlib.sha256(text).hexdigest()[:32])
            masks.append(own_failures(text))
        columns = [batch.column("doc_id"), batch.column("part"), pa.array(keys, pa.string()), pa.array(masks, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "key", "mask"])


def marks_of(labels: DataFrame) -> DataFrame:
    """_id, good, toxic of every labelled document."""
    return (
        labels.where(ref("doc_id").isNotNull())
        .groupBy(ref("doc_id").alias("_id"))
        .agg(F.max(ref("quality") == 1).alias("good"), F.max(ref("toxic") == 1).alias("toxic"))
        .select("_id", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    )


def _combiner(buckets: int):
    """Counts of a task's documents: settled ones by part and mask, and per text those with its smallest id."""
    fields = ["part", "mask", "good", "toxic"]
    schema = pa.schema(
        [("bucket", pa.string()), ("key", pa.string()), ("least", pa.int64()), ("part", pa.string()), ("mask", pa.int32())]
        + [("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64())]
    )

    def combined(rows: pa.Table, settled: str) -> Iterator[pa.RecordBatch]:
        least = rows.group_by("key").aggregate([("doc_id", "min")]).rename_columns(["key", "least"])
        rows = rows.join(least, "key")
        first = pc.fill_null(pc.equal(rows["doc_id"], rows["least"]), False)
        # Counted as if no other task held a smaller id; a text's state corrects that.
        later = pc.and_(pc.invert(first), pc.is_valid(rows["doc_id"]))
        mask = pc.if_else(later, pc.bit_wise_or(rows["mask"], pa.scalar(REPEATED, pa.int32())), rows["mask"])
        counted = rows.set_column(rows.schema.get_field_index("mask"), "mask", mask).group_by(fields).aggregate([([], "count_all")])
        held = rows.filter(first).group_by(["key", "least", *fields]).aggregate([([], "count_all")])
        n = counted.num_rows
        bucket = [str(int(k[:15], 16) % buckets) for k in held["key"].to_pylist()]
        for part, own in (
            (counted, {"bucket": [settled] * n, "key": [""] * n, "least": [0] * n}),
            (held, {"bucket": bucket}),
        ):
            own = {c: pa.array(v, schema.field(c).type) for c, v in own.items()}
            columns = [own[c] if c in own else part[c] for c in schema.names[:-1]]
            yield from pa.Table.from_arrays([*columns, part["count_all"]], schema=schema).combine_chunks().to_batches()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = f"{_SETTLED}{TaskContext.get().partitionId() % 997}"
        gathered: list[pa.RecordBatch] = []
        for batch in batches:
            gathered.append(batch)
            if sum(b.num_rows for b in gathered) >= COMBINE_ROWS:
                yield from combined(pa.Table.from_batches(gathered), settled)
                gathered = []
        if gathered:
            yield from combined(pa.Table.from_batches(gathered), settled)

    return combine


_NAMES = ["part", "mask", "good", "toxic", "n"]


def _change(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the texts of a bucket: none by a text whose documents all have one id."""
    if key[0].startswith(_SETTLED):
        for frame in frames:
            yield frame[_NAMES]
        return
    texts: dict[str, list] = json.loads(state.get[0]) if state.exists else {}  # key: [smallest id, its counts]
    changes: list[tuple] = []

    def repeated(counts: list) -> None:
        for part, mask, good, toxic, n in counts:
            changes.append((part, mask, good, toxic, -n))
            changes.append((part, mask | REPEATED, good, toxic, n))

    for frame in frames:
        for digest, least, *count in zip(*(frame[c].tolist() for c in ["key", "least", *_NAMES])):
            held = texts.get(digest)
            if held is None or least < held[0]:
                if held is not None:
                    repeated(held[1])
                texts[digest] = [least, [count]]
            elif least > held[0]:
                repeated([count])
            else:
                same = next((c for c in held[1] if c[:-1] == count[:-1]), None)
                if same is None:
                    held[1].append(count)
                else:
                    same[-1] += count[-1]
    state.update((json.dumps(texts, separators=(",", ":")),))
    if changes:
        yield pd.DataFrame(changes, columns=_NAMES)


def document_stream(spark: SparkSession, path: str, batches: int = BATCHES) -> DataFrame:
    """A stream of the Parquet files at ``path`` (a folder or one file) in about ``batches`` micro-batches.

    A file is no folder to watch, and its own path is no pattern either: a
    pattern that fits it alone serves for both.
    """
    files = spark.read.parquet(path)
    per_batch = max(1, -(-len(files.inputFiles()) // batches))
    head, last = path.rstrip("/")[:-1], path.rstrip("/")[-1]
    return (
        spark.readStream.schema(files.schema)
        .option("maxFilesPerTrigger", per_batch)
        .option("maxFileAge", "36500d")  # no file is too old to be counted
        .parquet(f"{head}[{last}]")
    )


def _buckets(spark: SparkSession, folder: str, wanted: int) -> int:
    """The number of states, fixed by the first run on a folder."""
    path = f"{folder}/buckets"
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        spark.range(1).select(F.lit(wanted).cast("long").alias("n")).write.mode("overwrite").parquet(path)
    return spark.read.schema("n long").parquet(path).first()["n"]


def audit_stream(stream: DataFrame, labels: DataFrame, folder: str, buckets: int = 1000) -> DataFrame:
    """Counters (part, mask, good, toxic, n) of all documents that have come to ``folder`` so far.

    Takes what the stream has available now, on top of what earlier runs on the
    same folder took. The marks of a document are those of the run that takes it.
    ``buckets`` of texts share a state each; the first run on a folder fixes it.
    """
    spark = stream.sparkSession
    buckets = _buckets(spark, folder, buckets)
    marks = stage_table(marks_of(labels), "audit-marks")
    rows = stream.select(
        ref("doc_id").cast("long").alias("doc_id"),
        F.coalesce(ref("source").cast("string"), F.lit("")).alias("part"),
        text_of().cast("binary").alias("text"),
    ).mapInArrow(_judge, _JUDGED)
    # Null ids have no marks: their texts' hashes spread them, and the second key keeps them apart.
    spread = F.coalesce("doc_id", F.xxhash64("key"))
    on = (spread == F.col("_id")) & (F.col("doc_id").isNull() == F.col("_null"))
    marked = rows.join(marks.withColumn("_null", F.col("_id").isNull()), on, "left").select(
        "key",
        "doc_id",
        "part",
        "mask",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    changes = (
        marked.mapInArrow(_combiner(buckets), _CHANGE)
        .groupBy("bucket")
        .applyInPandasWithState(_change, _COUNTER, "texts string", "update", GroupStateTimeout.NoTimeout)
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        summed = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{folder}/counters/batch-{batch_id}")

    spark.createDataFrame([], _COUNTER).write.mode("overwrite").parquet(f"{folder}/counters/batch-none")
    query = (
        changes.writeStream.foreachBatch(save)
        .outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return (
        spark.read.schema(_COUNTER)
        .parquet(f"{folder}/counters/batch-*")
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def orders_of(counters: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from the counters."""
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, start=1):
            steps.append(("".join(order), step, bits[letter], before))
            before |= bits[letter]
    # A filter's effect depends on which filters came before it, not on their order: 80 cases, 600 steps.
    cases = sorted({(bit, before) for _order, _step, bit, before in steps})
    case = F.explode(F.array(*[F.struct(F.lit(bit).alias("bit"), F.lit(before).alias("before")) for bit, before in cases]))
    case = counters.withColumn("case", case).select("*", "case.bit", "case.before")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name)

    effects = case.groupBy("part", "bit", "before").agg(
        total(~fails & ~gone, "kept"),
        total(fails & ~gone, "removed"),
        total(fails & gone, "redundant"),
        total(F.col("mask") == F.col("bit"), "unique_fails"),
        total(fails & ~gone & F.col("good"), "good_lost"),
        total(fails & ~gone & F.col("toxic"), "toxic_lost"),
    )
    table = counters.sparkSession.createDataFrame(steps, "filter_order string, step int, _bit int, _before int")
    rows = effects.join(table, (F.col("bit") == F.col("_bit")) & (F.col("before") == F.col("_before")))
    return rows.select(
        "part",
        "filter_order",
        "step",
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley"),
    )


def audit_filters(spark: SparkSession, documents: str, labels: DataFrame, folder: str | None = None) -> DataFrame:
    """The audit of all documents in the Parquet files at ``documents``.

    ``folder`` keeps the stream's checkpoint, state and counters; a later call
    with the same folder takes only files that are new. Default: a fresh one.
    """
    folder = folder or scratch_path(spark, "filter-audit")
    buckets = max(1, -(-spark.read.parquet(documents).count() // TEXTS_PER_STATE))
    return orders_of(audit_stream(document_stream(spark, documents), labels, folder, buckets))
