"""What the operators share: words, row numbers, written tables, random bits."""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import new_dir

#: A word is a run of characters that are neither space nor one of U+0009 to U+000D. bytes.split() cuts there too.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: worked out once, and safe when executors are lost."""
    spark = df.sparkSession
    path = new_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns as (doc_id long, text binary), whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def row_numbers():
    """Numbers that no other partition of the same job gives out; they last once the rows are written."""
    start = TaskContext.get().partitionId() << 33
    while True:
        yield start
        start += 1


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids count as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer of unsigned integers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
