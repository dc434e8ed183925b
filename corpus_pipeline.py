"""Documents made ready for training, stage by stage: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import decontaminate, mixing, pii, simhash, toxicity
from claimlens.llm.common import fold, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores below its threshold."""
    learnable = fold(F.col("doc_id"), 3) != 1
    scored = toxicity.toxic_scores(docs, table(spark, sf_dir, "labels"), learnable, keep=docs.columns)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("kept.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that fingerprints of three-word shingles link at three bits or fewer, the document with the smallest id."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage that aligns with a benchmark item; ids play no part, so null and repeated ones do no harm."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(c) for c in docs.columns]).alias("kept"))
    rows = written(rows, "numbered")  # the numbers last once they are written
    benchmark = table(spark, sf_dir, "benchmark")
    leaks = decontaminate.contaminated(rows, benchmark, "row", "kept.text").select(F.col("doc_id").alias("row")).distinct()
    return rows.join(leaks, "row", "left_anti").select("kept.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; n_chars counts the new text."""
    masked = pii.redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
]
#: The scores, the fingerprints and the alignment of the stages have no SQL; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
