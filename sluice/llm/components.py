"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stage_table


def _size_and_hash(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``links`` (u, v).

    A large star hangs each larger neighbour of a node on the smallest node of
    its neighbourhood, a small star does so for the smaller ones; neither can
    split a component, and when both change nothing every node hangs on its
    root. A logarithmic number of rounds is needed, each ends in a table in the
    shared folder, and only a row count and a checksum reach the driver. The
    minimum of a node with many neighbours is combined before the shuffle.

    Null ends and loops are ignored; an empty table gives no rows.
    """
    edges = stage_table(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "cc",
    )
    before = _size_and_hash(edges)
    while before[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(down, F.col("u") == F.col("w")).select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        edges = stage_table(small, "cc")
        after = _size_and_hash(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
