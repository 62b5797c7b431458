"""Counts of a table's values from the footers of its files."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.types import quote

# Settings under which Spark answers counts from parquet footers.
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextlib.contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    kept = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_counts(spark: SparkSession, paths: list[str], schema, columns: list[str]) -> DataFrame:
    """One row: ``count(column)`` for each column, and ``rows``, from the footers of the parquet files at ``paths``.

    The plan is made here, while the settings hold; a filter would need the values themselves.
    """
    with _settings(spark, FOOTER_CONF):
        files = spark.read.schema(schema).parquet(*paths)
        counted = files.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(quote(c))).alias(c) for c in columns])
        counted._jdf.queryExecution().executedPlan()
    return counted


def not_null_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """field, n: how many rows of a parquet table have each column, without reading a column.

    ``table`` is a table or a folder of parquet files, whole or filtered by its
    partitions only. A table without files has no rows.
    """
    spark, paths = table.sparkSession, table.inputFiles()
    if not paths:
        return spark.createDataFrame([(c, 0) for c in columns], "field string, n long")
    row = footer_counts(spark, paths, table.select(*[quote(c) for c in columns]).schema, columns).first()
    return spark.createDataFrame([(c, row[c]) for c in columns], "field string, n long")
