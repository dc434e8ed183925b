"""Claim details parsed once, at load, into a VARIANT column: typed tables out of it with no schema and no parse in the query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import schemas
from claimlens.sources.tables import write


def with_detail(documents: DataFrame) -> DataFrame:
    """``documents`` with the VARIANT column ``detail`` in place of the text; text that is no JSON gives null."""
    kept = [c for c in documents.columns if c != "claim_detail"]
    return documents.select(*kept, F.try_parse_json("claim_detail").alias("detail"))


def write_details(claims: DataFrame, continuation: DataFrame, path: str, in_order: bool = False) -> None:
    """Claims and their further documents with parsed details below ``path``, claims laid out by member.

    Claims ``in_order`` are read from a table that is laid out by member: they are parsed where they are, without a shuffle.
    """
    write(with_detail(claims), f"{path}/claims", skip_empty=False, cluster_by=() if in_order else ["member_id", "claim_id"])
    write(with_detail(continuation), f"{path}/documents", skip_empty=False)


def read_details(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/claims"), spark.read.parquet(f"{path}/documents")


def _n_lines(detail: str = "detail") -> Column:
    return F.size(F.try_variant_get(detail, "$.line_items", "array<variant>"))


def variant_silver(claims: DataFrame, continuation: DataFrame) -> DataFrame:
    """What ``claims_silver`` gives, from the parsed details: line_count, copay, edits_triggered and has_cob."""
    get = lambda path, kind: F.try_variant_get("detail", f"$.adjudication.{path}", kind)
    more = continuation.groupBy("claim_id").agg(F.sum(_n_lines()).cast("int").alias("_more"))
    silver = claims.select(
        *[c for c in claims.columns if c != "detail"],
        _n_lines().alias("_own"),
        get("copay", "double").alias("copay"),
        get("edits_triggered", "array<string>").alias("edits_triggered"),
        get("coordination_of_benefits", "boolean").alias("has_cob"),
    )
    kept = [c for c in silver.columns if c not in ("_own", "copay", "edits_triggered", "has_cob")]
    counted = (F.col("_own") + F.coalesce("_more", F.lit(0))).alias("line_count")
    return silver.join(more, "claim_id", "left").select(*kept, counted, "copay", "edits_triggered", "has_cob")


def variant_lines(claims: DataFrame, continuation: DataFrame) -> DataFrame:
    """One row per claim line with every field of the line, the arrays taken apart by ``variant_explode``."""
    spark = claims.sparkSession
    fields = T.DataType.fromDDL(schemas.LINE_ITEM).fields

    def lines(documents: DataFrame) -> DataFrame:
        items = F.try_variant_get(F.col("detail").outer(), "$.line_items", "variant")
        each = documents.select("claim_id", "detail").lateralJoin(spark.tvf.variant_explode(items))
        return each.select("claim_id", *[F.try_variant_get("value", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields])

    return lines(claims).union(lines(continuation))
