"""The dealt operators as queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import alignment, audit, decontaminate, language, mixing, neighbours, pii, quality, simhash, substring, tokens, toxicity, warc
from claimlens.llm.common import fold, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    shown = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    scored = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    scored = toxicity.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    told = language.languages(table(spark, sf_dir, "documents"), ~held_out)
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.archived(spark, manifest, folder).withColumnRenamed("record_id", "page_id")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.annotated(table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.as_text("base"), 256).alias("base_sha256"), pii.as_text("spans").alias("spans"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_scores(table(spark, sf_dir, "documents"))


def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_language": op5_language,
    "op6_decontamination": op6_decontamination,
    "op7_warc": op7_warc,
    "op8_neighbours": op8_neighbours,
    "op9_pii": op9_pii,
    "op10_mixing": op10_mixing,
    "op11_tokens": op11_tokens,
    "op12_alignment": op12_alignment,
    "op13_filters": op13_filters,
}
