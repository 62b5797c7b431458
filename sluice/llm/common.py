"""Shared helpers: ASCII word splitting, stage tables, tree sums of vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.types import quote
from sluice.session import scratch_path

# The six characters of [\x20\x09-\x0D] that part words, and ASCII letters.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ref(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(quote(name))


def text_of(name: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(ref(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the maximal runs of characters outside ``BLANKS``."""
    spaced = F.translate(text, BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column) -> Column:
    """Sum of an array of numbers; 0 when it is empty."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write a stage to the shared folder and read it back.

    Cuts the lineage: later steps reread files that every executor sees, so a
    lost executor costs no recomputation. The folder goes when the driver's JVM
    ends, or with ``drop_stage`` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    drop_at_exit(spark, path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._stage_folder = path
    return staged


def drop_stage(*staged: DataFrame) -> None:
    """Delete the folders of stage tables whose successors are written."""
    for df in staged:
        path = df.__dict__.get("_stage_folder")
        if path:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


# Rows of whole texts that go to Python at once: Arrow buffers double as they grow, in the JVM and beside it.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to ``BATCH_ROWS``; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def global_rank(df: DataFrame, keys: list[Column], name: str, label: str) -> DataFrame:
    """1-based rank of each row by ``keys`` without sorting everything in one task.

    Rows are range-partitioned and written; each partition is numbered on its
    own and shifted by the row count of those before it (one row per partition).
    """
    ranged = stage_table(
        df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), f"{label}-ranged"
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn(
        "_before",
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n"),
    ).drop("_n")
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return (
        ranged.withColumn("_local", local)
        .join(before, "_part")
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_part", "_local", "_before")
    )
