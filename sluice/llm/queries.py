"""The registered queries of the subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    chat,
    collocations,
    decontaminate,
    filter_audit,
    licenses,
    line_dedup,
    lm_scoring,
    mixing,
    passages,
    quality_gam,
    quality_rules,
    simhash_ball,
    toxicity,
)
from sluice.llm.labelled import fold


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_read(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_ball.simhash_components(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_ball.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return scored.select(
        "doc.doc_id",
        (fold(F.col("doc.doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = line_dedup.dedup_lines(_read(spark, sf_dir, "documents"))
    return held.select("doc.doc_id", "n_lines", "n_dropped", _sha256(F.col("text")).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_gam.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return scored.select(
        "doc.doc_id",
        (fold(F.col("doc.doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark_contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with windows of benchmark items that are near, and not equal: the proximity matches of operator 7."""
    marked = decontaminate.mark_contaminated(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), slop=decontaminate.SLOP
    )
    return marked.where(F.size("near_items") > 0).select("doc.doc_id", F.array_join("near_items", ",").alias("near_items"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(_read(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage once for each of its two documents, so ``doc_id`` names all that share one."""
    found = passages.passages(_read(spark, sf_dir, "documents"))
    sides = [("doc_id", "start", "n_words"), ("other_id", "other_start", "other_words")]
    views = [
        F.struct(*[F.col(c).alias(n) for c, n in zip((*mine, *others), (*sides[0], *sides[1]))], "edits", "similarity")
        for mine, others in (sides, sides[::-1])
    ]
    return found.select(F.inline(F.array(*views))).select(*found.columns)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    back = chat.read_back(chat.format_chats(chat.rows_as_events(rows.unionByName(odd))))
    turn_texts = F.transform("turns", lambda t: F.concat(t.getField("role"), F.lit("\n"), t.getField("text"), F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha256(F.array_join(turn_texts, "")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        _sha256(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(spark, f"{sf_dir}/documents.parquet", _read(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents")).drop("words")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join("expressions", "; ").alias("expressions"),
    )


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_decontaminate": op7_decontaminate,
    "benchmark_proximity": benchmark_proximity,
    "op8_mix_sources": op8_mix_sources,
    "op9_passages": op9_passages,
    "op10_chat_format": op10_chat_format,
    "op11_filter_audit": op11_filter_audit,
    "op12_collocations": op12_collocations,
    "op13_license_scan": op13_license_scan,
}
