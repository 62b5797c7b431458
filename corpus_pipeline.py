"""From raw documents to a training mix: five stages, each one operator of ``sluice.llm``.

Every stage takes the documents that the one before it kept and returns
documents with the same columns; the last one returns the mix, a row per copy.

Defined cases, for all stages
-----------------------------
* null or empty text: judged as a text without words; not toxic unless the fit
  says so of no evidence, has no repeated line, is a near copy of other empty
  texts (one of them stays), holds no benchmark window, and takes no part of the mix.
* null ``doc_id``: scored and compared like any other row; such rows are one
  document for the line counts, cannot be told apart as near copies and stay.
* null ``source``: a source of its own. Nulls in other columns are carried.
* repeated rows: scored alike; rows of one id are one document for the line
  counts and near copies; what is left of them is mixed row by row.
* ties: the largest id keeps a repeated line, the smallest id stands for near copies.
* empty ``documents``: no rows. Empty ``labels``: nothing is toxic. Empty
  ``benchmark``: nothing is contaminated.
* extra columns are carried whatever their names; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, line_dedup, mixing, simhash_ball, toxicity
from sluice.llm.common import drop_stage, stage_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in three documents or more stay in the largest one only."""
    return line_dedup.without_repeated_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash_ball.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or thinned out to the target weights of their sources."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_to_target_weights", mix_sources),
]

# Trained scores, XXH64 fingerprints and components are beyond SQL; tests hold a brute-force version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_stage(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
