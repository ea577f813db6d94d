"""The queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import confusables, langid, leakage, matching, mixture, names, readability, scans, transcripts
from .common import checkpointed, table


def p1_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matches(table(spark, sf_dir, "speaker_detail"), table(spark, sf_dir, "person_binding"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_matches(spark, sf_dir).select("speaker_id", "binding_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.defects(table(spark, sf_dir, "line_record"))


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.paragraphs(table(spark, sf_dir, "line_record"))


def p3_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.runs_in_form(table(spark, sf_dir, "character_run"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_forms(spark, sf_dir).where("changed").select("run_id")


def p3_look_alikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.look_alikes(table(spark, sf_dir, "character_run"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.turn_starts(table(spark, sf_dir, "transcript_line"), table(spark, sf_dir, "speaker_mapping"))


def p4_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.turns(table(spark, sf_dir, "transcript_line"), table(spark, sf_dir, "speaker_mapping"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.persons(table(spark, sf_dir, "speaker_detail"), "speaker_id", "lookup_name", "organization")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.same_person_pairs(p5_groups(spark, sf_dir), "speaker_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, lines = p6_documents(spark, sf_dir), p6_lines(spark, sf_dir)
    label = langid.label_language(F.col("label"))
    texts = documents.where((F.col("seg_no") >= 0) | ~label.eqNullSafe(F.col("lang"))).where("lang is not null")
    texts = texts.select(F.col("doc_id").cast("string").alias("doc_key"), F.lit(-1).alias("page_no"), "seg_no", "lang")
    lines = lines.where(F.col("page_num").isNotNull() | ~label.eqNullSafe(F.col("lang"))).select(
        F.col("doc_id").alias("doc_key"), F.coalesce("page_num", F.lit(-1)).alias("page_no"), F.coalesce("line_idx", F.lit(-1)).alias("seg_no"), "lang"
    )
    return texts.unionByName(lines)


def p6_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.document_languages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "graded_passage"))


def p6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of line_record (no page) and their lines in other languages."""
    text = scans.text_lines(table(spark, sf_dir, "line_record"))
    docs, lines = langid.line_languages(text, table(spark, sf_dir, "graded_passage"))
    labels = table(spark, sf_dir, "line_profile").groupBy("doc_id").agg(F.min("corpus_language").alias("label"))
    docs = docs.join(labels, "doc_id", "left").select("doc_id", F.lit(None).cast("int").alias("page_num"), F.lit(None).cast("int").alias("line_idx"), "lang", "confidence", "label")
    return docs.unionByName(lines.withColumn("label", F.lit(None).cast("string")))


def p7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark_item"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_leaks(spark, sf_dir).select("doc_id", "item_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = checkpointed(mixture.sized_documents(table(spark, sf_dir, "documents")))
    plan = mixture.replication_plan(sized, table(spark, sf_dir, "mixture_target"))
    return mixture.shares(sized, plan)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose drawn copies stay below what is wanted with every
    document used as often as it may be."""
    drawn = p8_shares(spark, sf_dir).where("mixed_tokens < wanted and mixed_tokens = tokens * max_repeats")
    return drawn.select("source")


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    plan = mixture.replication_plan(mixture.sized_documents(documents), table(spark, sf_dir, "mixture_target"))
    return mixture.mix(documents.select("doc_id", "source", "text"), plan)


def p9_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "graded_passage"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_levels(spark, sf_dir).select("doc_id", "band")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_matches, p2_found, p2_paragraphs, p3_found, p3_forms, p3_look_alikes, p4_found, p4_turns, p5_found, p5_groups, p6_found, p6_documents, p6_lines, p7_found, p7_leaks, p8_found, p8_shares, p8_mixture, p9_found, p9_levels)
}

SQL: dict[str, str] = {}
