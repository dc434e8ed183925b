"""The data-quality report: one row per check with its number of violations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions.nested import detail_has_source, detail_parses, json_contains, parse_detail
from claimlens.functions.scores import dollars, violations
from claimlens.operators.governance import check_foreign_keys, check_primary_keys, constraint_listing, mask_report
from claimlens.plans.metrics import DISPOSITION_METRICS, action_gap, denial_dollars, dollar_exposure, metric_query


def _rows(one: DataFrame) -> DataFrame:
    """A one-row frame of named counts as (check_id, violations) rows."""
    pairs = [F.struct(F.lit(c).alias("check_id"), F.col(c).cast("bigint").alias("violations")) for c in one.columns]
    return one.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def claim_rules(claims: DataFrame, expected: Column | int) -> DataFrame:
    """D1 and all row-level rules on claims in one scan; the detail rules where the column is there."""
    denied = F.col("status") == "Denied"
    rules = {
        "D8": F.col("paid_amount") > F.col("billed_amount"),
        "D9": denied & (F.col("paid_amount") != 0),
        "D10": denied & F.col("denial_reason").isNull(),
        "D11": ~F.col("requires_manual_review").isin(0, 1),
        "D12": ~F.col("status").isin(schemas.STATUSES),
    }
    if "claim_detail" in claims.columns:
        rules["D7"] = ~detail_has_source()
        rules["detail_parses"] = ~detail_parses()
    counted = claims.agg(F.count(F.lit(1)).alias("D1"), *[violations(rule).alias(check) for check, rule in rules.items()])
    return _rows(counted.withColumn("D1", F.abs(F.col("D1") - _value(expected))))


def _value(expected: Column | int) -> Column:
    return expected if isinstance(expected, Column) else F.lit(expected)


def key_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """D2: surplus claim rows; D4 to D6: claims and events without a parent."""
    keys = check_primary_keys({"claims": tables["claims"]})
    unique = keys.select(F.lit("D2").alias("check_id"), F.col("duplicate_keys").alias("violations"))
    names = {"claims_member_fk": "D4", "claims_provider_fk": "D5", "disp_claim_fk": "D6"}
    wanted = {t: tables[t] for t in ("members", "providers", "claims", "disposition_events")}
    label = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])[F.col("constraint_name")]
    return unique.union(check_foreign_keys(wanted).select(label.alias("check_id"), F.col("orphan_rows")))


def count_rule(check: str, df: DataFrame, expected: Column | int) -> DataFrame:
    """How far the row count is from what is expected: a number, or a scalar subquery."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.lit(check).alias("check_id"), F.abs(F.col("n") - _value(expected)).cast("bigint").alias("violations"))


def view_rules(claims: DataFrame, events: DataFrame, stored_gap: DataFrame | None = None) -> DataFrame:
    """V1: exposure by status adds up to the claims within one unit per status; V2: rates lie in
    [0, 1]; V3: reasons are present; P1: three dispositions; I1: the stored action gap, or without one the
    built view, agrees with the certified metric over the events as they are now."""
    total = claims.agg(F.round(dollars(F.col("billed_amount")))).scalar()
    drift = F.abs(F.sum("total_billed") - total)
    v1 = dollar_exposure(claims).agg((drift > len(schemas.STATUSES)).cast("bigint").alias("V1"))
    gap = action_gap(events) if stored_gap is None else stored_gap
    v2 = gap.agg(
        violations(~F.col("action_fired_rate").between(0, 1)).alias("V2"),
        F.abs(F.count(F.lit(1)) - 3).alias("P1"),
    )
    v3 = denial_dollars(claims).agg(violations(F.col("denial_reason").isNull()).alias("V3"))
    asked = metric_query(DISPOSITION_METRICS, events, ["Disposition"], ["Disposition Count", "Downstream Action Fired Rate"])
    other = asked.select(
        F.col("Disposition").alias("disposition"),
        F.col("Disposition Count").alias("n"),
        F.round("Downstream Action Fired Rate", 3).alias("rate"),
    )
    both = gap.join(other, "disposition", "full_outer")
    same = F.col("dispositions").eqNullSafe(F.col("n")) & F.col("action_fired_rate").eqNullSafe(F.col("rate"))
    i1 = both.agg(violations(~same).alias("I1"))
    return reduce(DataFrame.union, [_rows(v) for v in (v1, v2, v3, i1)])


def priority_rules(priority: DataFrame, claims: DataFrame) -> DataFrame:
    """M1: one score per claim; M2: scores in [0, 1]; M3: no score without a claim; M4: denied claims
    score higher on average than paid ones."""
    claim_count = claims.agg(F.count(F.lit(1))).scalar()
    score = F.col("manual_review_score")
    alone = priority.agg(
        F.abs(F.count(F.lit(1)) - claim_count).alias("M1"), violations(~score.between(0.0, 1.0)).alias("M2")
    )
    # The score table is matched once for M3 and M4: a row without a status has no claim.
    matched = priority.join(claims.select("claim_id", F.col("status"), F.lit(True).alias("known")), "claim_id", "left")
    mean = lambda s: F.round(F.avg(F.when(F.col("status") == s, score)), 9)
    joined = matched.agg(
        violations(F.col("known").isNull()).alias("M3"),
        F.when(mean("Denied") > mean("Paid"), 0).otherwise(1).alias("M4"),
    )
    return _rows(alone).union(_rows(joined))


def state_rules(state: DataFrame, claims: DataFrame, expected: Column | int) -> DataFrame:
    """L1: current-state rows; L2: some rows have lines; L3: the containment filter finds the same rows as
    the flag itself; I2: every row has the status of its claim. One pass over the state."""
    schema = "struct<adjudication:struct<coordination_of_benefits:boolean>, line_items:array<struct<line:int>>>"
    now = claims.select("claim_id", F.col("status").alias("_now"))
    parsed = state.join(now, "claim_id", "left").withColumn("_d", parse_detail(schema=schema))
    d = F.col("_d")
    flag = d.adjudication.coordination_of_benefits
    contained = json_contains(d, {"adjudication": {"coordination_of_benefits": True}})
    counted = parsed.agg(
        F.abs(F.count(F.lit(1)) - _value(expected)).alias("L1"),
        F.when(violations(F.size(d.line_items) > 0) > 0, 0).otherwise(1).alias("L2"),
        violations(contained != F.coalesce(flag, F.lit(False))).alias("L3"),
        violations(~F.col("status").eqNullSafe(F.col("_now"))).alias("I2"),
    )
    return _rows(counted)


def governance_rules(masked_members: DataFrame) -> DataFrame:
    """G1: ten declared keys; G2 to G4: no personal value in clear."""
    spark = masked_members.sparkSession
    declared = count_rule("G1", constraint_listing(spark), 10)
    names = {"member_ssn": "G2", "member_name": "G3", "member_dob": "G4"}
    label = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])[F.col("column_name")]
    return declared.union(mask_report(masked_members).select(label, "unmasked"))


def quality_report(
    tables: Mapping[str, DataFrame],
    expected_claims: Column | int,
    expected_members: Column | int,
    masked_members: DataFrame,
    priority: DataFrame | None = None,
    state: DataFrame | None = None,
    expected_state: Column | int = 500,
    stored_gap: DataFrame | None = None,
) -> DataFrame:
    """(check_id, violations, passed) for every check the given tables allow."""
    parts = [
        claim_rules(tables["claims"], expected_claims),
        count_rule("D3", tables["members"], expected_members),
        key_rules(tables),
        governance_rules(masked_members),
        view_rules(tables["claims"], tables["disposition_events"], stored_gap),
    ]
    if priority is not None:
        parts.append(priority_rules(priority, tables["claims"]))
    if state is not None:
        parts.append(state_rules(state, tables["claims"], expected_state))
    report = reduce(DataFrame.union, parts)
    # Every part ends in a one-row aggregate, so the one task here only sorts the report's few rows.
    return report.withColumn("passed", F.col("violations") == 0).coalesce(1).sortWithinPartitions("check_id")
