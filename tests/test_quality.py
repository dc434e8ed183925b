"""The report must pass on good data and count exactly the planted faults on bad data."""

import pytest
from conftest import claim, frame
from pyspark.sql import functions as F

from checks import queries
from claimlens.operators import governance, quality, serving


def report(tables, spark, **more):
    masked = governance.members_for(tables["members"])
    expected = {"expected_claims": tables["claims"].count(), "expected_members": tables["members"].count()}
    made = quality.quality_report(tables, **{**expected, "masked_members": masked, **more})
    return {r.check_id: r.violations for r in made.collect()}


def test_good_book_passes(spark, sf_dir):
    made = queries.quality_report(spark, sf_dir)
    failed = {r.check_id for r in made.where("NOT passed").collect()}
    assert failed <= {"M4"}  # the formula score does not know the status
    assert made.count() == 30


@pytest.fixture(scope="module")
def bad(spark):
    person = {"member_ssn": "123-45-6789", "member_name": "A", "member_dob": "1970-01-01"}
    members = [{"member_id": f"M{i}", **person} for i in range(1, 4)]
    members += [{"member_id": "M4"}, {"member_id": "M5", "member_ssn": "678", "member_name": "", "member_dob": "1"}]
    claims = [
        claim(1),
        claim(1),
        claim(2, member_id="M77"),
        claim(3, paid_amount=500.0),
        claim(4, status="Denied", denial_reason="Non-covered charge", paid_amount=1.0),
        claim(5, status="Denied", paid_amount=0.0),
        claim(6, requires_manual_review=2),
        claim(7, status="Void"),
        claim(8, claim_detail="{broken"),
        claim(9, provider_id=None),
    ]
    events = [
        {"event_id": f"E{i}", "claim_id": f"C{i}", "disposition": d, "downstream_action_fired": i % 2 == 0}
        for i, d in enumerate(["Paid", "Denied", "Partially Paid", "Paid"], start=1)
    ]
    events.append({"event_id": "E9", "claim_id": "C404", "disposition": "Paid", "downstream_action_fired": True})
    return {
        "members": frame(spark, "members", members),
        "providers": frame(spark, "providers", [{"provider_id": "P1"}]),
        "claims": frame(spark, "claims", claims),
        "disposition_events": frame(spark, "disposition_events", events),
    }


def test_planted_faults_are_counted(spark, bad):
    found = report(bad, spark)
    planted = {"D2": 1, "D4": 1, "D5": 1, "D6": 1, "D7": 1, "detail_parses": 1, "D8": 1, "D9": 1, "D10": 1, "D11": 1, "D12": 1}
    assert {c: n for c, n in found.items() if n} == {**planted, "G4": 1}


def test_row_counts(spark, bad):
    found = report(bad, spark, expected_claims=12, expected_members=F.lit(5))
    assert found["D1"] == 2 and found["D3"] == 0


def test_clear_members_fail(spark, bad):
    found = report(bad, spark, masked_members=bad["members"])
    assert (found["G1"], found["G2"], found["G3"], found["G4"]) == (0, 4, 4, 4)


def test_priority_rules(spark, bad):
    claims = bad["claims"].dropDuplicates(["claim_id"])
    made = [("C4", 0.9), ("C5", 0.8), ("C1", 0.1), ("C2", 1.5), ("C404", 0.5)]
    priority = spark.createDataFrame(made, "claim_id string, manual_review_score double")
    found = {r.check_id: r.violations for r in quality.priority_rules(priority, claims).collect()}
    assert found == {"M1": 4, "M2": 1, "M3": 1, "M4": 0}
    flipped = priority.withColumn("manual_review_score", 1 - F.col("manual_review_score"))
    found = {r.check_id: r.violations for r in quality.priority_rules(flipped, claims).collect()}
    assert found["M4"] == 1 and found["M2"] == 1


def test_state_rules(spark, bad):
    claims = bad["claims"].dropDuplicates(["claim_id"])
    state = serving.current_state(claims, bad["disposition_events"], None)
    found = {r.check_id: r.violations for r in quality.state_rules(state, claims, 9).collect()}
    assert found == {"L1": 0, "L2": 0, "L3": 0, "I2": 0}
    stale = state.withColumn("status", F.when(F.col("claim_id") == "C3", "Denied").otherwise(F.col("status")))
    found = {r.check_id: r.violations for r in quality.state_rules(stale, claims, 500).collect()}
    assert found["L1"] == 491 and found["I2"] == 1
