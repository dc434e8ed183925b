"""Typed tables out of the claims book: silver claims, claim lines, open dispositions, detail filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions.nested import json_contains, parse_detail, variant_contains
from claimlens.functions.sizing import evaluated_once

# The parse names only the fields it hands on, so the long line texts are skipped, not built.
_SILVER_DETAIL = (
    "struct<adjudication:struct<copay:double, coordination_of_benefits:boolean, edits_triggered:array<string>>, "
    "line_items:array<struct<line:int>>>"
)
_LINES_ONLY = f"struct<line_items:array<{schemas.LINE_ITEM}>>"


def claims_silver(claims: DataFrame, continuation: DataFrame) -> DataFrame:
    """Claims with line_count, copay, edits_triggered and has_cob parsed out of the detail.

    One parse per row. ``continuation`` holds further documents (claim_id, part,
    claim_detail) of claims too long for one; their lines are counted in.
    """
    d = F.col("_d")
    silver = claims.withColumn("_d", parse_detail(schema=_SILVER_DETAIL)).select(
        *claims.columns,
        F.size(d.line_items).alias("line_count"),
        d.adjudication.copay.alias("copay"),
        d.adjudication.edits_triggered.alias("edits_triggered"),
        d.adjudication.coordination_of_benefits.alias("has_cob"),
    )
    return _count_continued(silver, continuation)


def _count_continued(counted: DataFrame, continuation: DataFrame) -> DataFrame:
    """Add the lines of the continuation documents to line_count."""
    lines = F.json_array_length(F.get_json_object("claim_detail", "$.line_items"))
    more = continuation.groupBy("claim_id").agg(F.sum(lines).cast("int").alias("_more"))
    total = F.col("line_count") + F.coalesce("_more", F.lit(0))
    return counted.join(more, "claim_id", "left").withColumn("line_count", total).select(counted.columns)


def claim_lines(claims: DataFrame, continuation: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per claim line with every field of the line; ``keep_empty`` keeps claims without lines."""
    explode = F.explode_outer if keep_empty else F.explode

    def lines(documents: DataFrame, explode) -> DataFrame:
        items = parse_detail(schema=_LINES_ONLY).getField("line_items")
        return documents.select("claim_id", explode(items).alias("item")).select("claim_id", "item.*")

    first = lines(claims, explode)
    return first.union(lines(continuation, F.explode))


def open_dispositions(events: DataFrame) -> DataFrame:
    """Dispositions whose follow-up action did not fire. An unknown flag is not an open disposition."""
    return events.where(~F.col("downstream_action_fired"))


_COB = {"adjudication": {"coordination_of_benefits": True}}
_COB_DETAIL = "struct<adjudication:struct<coordination_of_benefits:boolean>>"


def cob_claims(claims: DataFrame) -> DataFrame:
    return claims.where(json_contains(parse_detail(schema=_COB_DETAIL), _COB, _COB_DETAIL))


_LINES = "line_items"


def detail_matches(claims: DataFrame, pattern: dict, continuation: DataFrame | None = None) -> DataFrame:
    """Claims whose detail contains ``pattern``, any JSON object.

    Reads the VARIANT column ``detail`` where the claims have one, else the text, parsed once a row. Details that are no JSON contain
    nothing. With ``continuation`` the lines of a long claim count together, whatever documents they are in: each line that
    the pattern asks for may be in another document.
    """
    lines = pattern.get(_LINES)
    split = continuation is not None and isinstance(lines, list) and bool(lines)
    asked = [{_LINES: [line]} for line in lines] if split else []
    rest = {k: v for k, v in pattern.items() if not (split and k == _LINES)}

    def tested(documents: DataFrame, tests: dict[str, dict]) -> DataFrame:
        value = F.col("detail") if "detail" in documents.columns else F.try_parse_json("claim_detail")
        parsed = evaluated_once(documents.withColumn("_v", value), "_v")
        return parsed.withColumns({name: variant_contains(F.col("_v"), p) for name, p in tests.items()}).drop("_v")

    if not split:
        return tested(claims, {"_rest": pattern}).where("_rest").drop("_rest")
    names = [f"_line{k}" for k in range(len(asked))]
    own = tested(claims, {"_rest": rest, **dict(zip(names, asked))}).where("_rest")
    more = tested(continuation, dict(zip(names, asked))).groupBy("claim_id").agg(*[F.bool_or(n).alias(f"{n}_more") for n in names])
    met = own.join(more, "claim_id", "left")
    return met.where(reduce(Column.__and__, [F.col(n) | F.coalesce(f"{n}_more", F.lit(False)) for n in names])).select(claims.columns)


def hybrid_rows(claims: DataFrame, continuation: DataFrame) -> DataFrame:
    """Relational columns next to nested ones: the other payer and the number of lines."""
    schema = "struct<adjudication:struct<cob_payer:string>, line_items:array<struct<line:int>>>"
    d = F.col("_d")
    rows = claims.withColumn("_d", parse_detail(schema=schema)).select(
        "claim_id",
        "member_id",
        "status",
        "denial_reason",
        "billed_amount",
        d.adjudication.cob_payer.alias("cob_payer"),
        F.size(d.line_items).alias("line_count"),
    )
    return _count_continued(rows, continuation)


def documents_of(claims: DataFrame, continuation: DataFrame) -> DataFrame:
    """The continuation documents of a few claims, so that no others are parsed."""
    return continuation.join(claims.select("claim_id"), "claim_id", "left_semi")


def denied_for_review(claims: DataFrame, continuation: DataFrame, limit: int = 5) -> DataFrame:
    """The dearest denied claims that need a review, with their nested fields.

    The rows are chosen on the plain columns first, so only ``limit`` details are parsed.
    """
    wanted = (F.col("status") == "Denied") & (F.col("requires_manual_review").cast("int") == 1)
    top = claims.where(wanted).orderBy(F.desc("billed_amount"), "claim_id").limit(limit)
    return hybrid_rows(top, documents_of(top, continuation)).orderBy(F.desc("billed_amount"), "claim_id")


def member_cob_claims(claims: DataFrame, member_id: str, continuation: DataFrame) -> DataFrame:
    """One member's claims with coordination of benefits. Over claims written by member only the files and row
    groups that can hold the member are read."""
    found = cob_claims(claims.where(F.col("member_id") == member_id))
    return hybrid_rows(found, documents_of(found, continuation))
