"""Checking model replies before they are written back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions.sizing import evaluated_once


def unfenced(reply: str) -> Column:
    """The reply without a code fence around it."""
    text = F.trim(F.col(reply))
    inside = F.regexp_extract(text, r"(?s)^```[^\n]*\n(.*?)\n?`*\s*$", 1)
    return F.when(text.startswith("```"), inside).otherwise(text)


def judge_replies(replies: DataFrame) -> DataFrame:
    """Replies (claim_id, reply) with their typed parts and the reason a reply is refused, null for a good one.

    A good reply is a JSON object with all four keys, an allowed action and a score from 0 to 1.
    """
    # One parse gives keys and values: the object as a map of texts, null for anything else.
    parsed = replies.withColumn("_m", F.from_json(unfenced("reply"), "map<string,string>"))
    m = F.col("_m")
    missing = [~F.map_contains_key(m, key) for key in schemas.REPLY_KEYS]
    score = m["triage_score"].try_cast("double")
    reason = (
        F.when(m.isNull(), "not json")
        .when(reduce(Column.__or__, missing), "missing key")
        .when(F.coalesce(~m["next_action"].isin(schemas.NEXT_ACTIONS), F.lit(True)), "unknown action")
        .when(F.coalesce(~score.between(0.0, 1.0), F.lit(True)), "score out of range")
    )
    return evaluated_once(parsed, "_m").select(
        "claim_id",
        "reply",
        score.alias("triage_score"),
        m["risk_tier"].alias("risk_tier"),
        m["next_action"].alias("triage_action"),
        m["rationale"].alias("rationale"),
        reason.alias("reason"),
    )


def validate_replies(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split replies into good ones, typed, and quarantined ones with the reason.

    Each of the two is a pass over the replies; ``judge_replies`` is both in one.
    """
    judged = judge_replies(replies)
    good = judged.where(F.col("reason").isNull()).drop("reply", "reason")
    return good, judged.where(F.col("reason").isNotNull()).select("claim_id", "reply", "reason")
