"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long): root is the smallest node it can reach.

    Each round is a few hash aggregates and joins and is written to the shared folder, which also cuts the
    lineage; a node with very many neighbours is only met by its minimum and by joins that can be split: minima are written
    first, since Spark splits no join that follows an aggregate on the same key without a shuffle between them.
    """
    now = written(edges.where("a <> b").select("a", "b"), "edges")
    before = _state(now)
    while before[0]:
        now = written(_small_star(written(_large_star(now), "large-star")), "small-star")
        after = _state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
