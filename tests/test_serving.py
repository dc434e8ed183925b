import datetime
from decimal import Decimal

import pytest
from conftest import claim, frame, rows
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.operators import replies, serving


def event(n, claim_id, ts, disposition="Paid"):
    return {"event_id": f"E{n}", "claim_id": claim_id, "disposition": disposition, "disposition_ts": ts}


@pytest.fixture(scope="module")
def claims(spark):
    made = [
        claim(1, billed_amount=10.0),
        claim(2, billed_amount=30.125, requires_manual_review=1, status="Denied"),
        claim(3, billed_amount=30.125, requires_manual_review=None, status="Pending"),
        claim(4, billed_amount=20.0, status="Partially Paid"),
    ]
    return frame(spark, "claims", made)


@pytest.fixture(scope="module")
def events(spark):
    made = [
        event(1, "C1", "2024-01-01T10:00:00"),
        event(2, "C2", "2024-01-02T10:00:00"),
        event(3, "C2", "2024-01-03T09:00:00", "Denied"),
        event(4, "C4", "not a time"),
    ]
    return frame(spark, "disposition_events", made)


def test_current_state(claims, events):
    state = serving.current_state(claims, events, 3)
    assert [(f.name, f.dataType) for f in state.schema] == [(f.name, f.dataType) for f in schemas.CLAIM_STATUS]
    got = state.select("claim_id", "billed_amount", "requires_manual_review", "last_disposition_ts")
    assert rows(got, "claim_id") == [
        ("C2", Decimal("30.13"), True, datetime.datetime(2024, 1, 3, 9)),
        ("C3", Decimal("30.13"), False, None),
        ("C4", Decimal("20.00"), False, None),
    ]
    assert serving.current_state(claims, events, None).count() == 4
    whole = serving.current_state(claims, events, None).drop("updated_at")
    assert state.drop("updated_at").exceptAll(whole).isEmpty()


def test_insert_if_absent_keeps_existing_rows(claims, events):
    state = serving.current_state(claims.where("claim_id < 'C3'"), events).withColumn("triage_action", F.lit("kept"))
    new = serving.current_state(claims, events)
    both = serving.insert_if_absent(state, new.union(new))
    assert rows(both.select("claim_id", "triage_action"), "claim_id") == [
        ("C1", "kept"),
        ("C2", "kept"),
        ("C3", None),
        ("C4", None),
    ]


def test_upsert_takes_only_newer_events(spark, claims, events):
    state = serving.current_state(claims, events)
    later = frame(
        spark,
        "disposition_events",
        [
            event(7, "C1", "2023-12-31T00:00:00", "Denied"),  # older: state stays
            event(8, "C2", "2024-02-01T00:00:00", "Paid"),
            event(9, "C2", "2024-02-01T00:00:00", "Partially Paid"),  # same time: larger event id wins
            event(10, "C3", "2024-02-01T00:00:00", "Denied"),  # no disposition so far
            event(11, "C99", "2024-02-01T00:00:00", "Paid"),  # not in state
            event(12, "C1", "soon", "Denied"),  # no readable time: never newer than a known one
            event(13, "C98", "soon", "Denied"),  # but better than nothing
        ],
    )
    after = serving.upsert_latest(state, later)
    assert after.columns == state.columns
    assert rows(after.select("claim_id", "status", "member_id"), "claim_id") == [
        ("C1", "Paid", "M1"),
        ("C2", "Partially Paid", "M1"),
        ("C3", "Denied", "M1"),
        ("C4", "Partially Paid", "M1"),
        ("C98", "Denied", None),
        ("C99", "Paid", None),
    ]
    again = serving.upsert_latest(after, later)
    assert again.drop("updated_at").exceptAll(after.drop("updated_at")).isEmpty()


def test_latest_does_not_depend_on_order_or_repeats(spark):
    made = [event(i, f"C{i % 3}", f"2024-01-{1 + i % 5:02d}T00:00:00", f"D{i}") for i in range(20)]
    one = frame(spark, "disposition_events", made)
    other = frame(spark, "disposition_events", (made + made[:7])[::-1])
    assert rows(serving.latest_dispositions(one), "claim_id") == rows(serving.latest_dispositions(other), "claim_id")


def test_write_back(spark, claims, events):
    state = serving.current_state(claims, events).withColumn("triage_action", F.lit("old"))
    columns = "claim_id string, triage_score double, triage_action string"
    scores = spark.createDataFrame([("C1", 0.12345, "none"), ("C2", None, None)], columns)
    got = serving.write_back(state, scores).select("claim_id", "triage_score", "triage_action")
    assert rows(got, "claim_id") == [
        ("C1", Decimal("0.1235"), "none"),
        ("C2", None, "old"),
        ("C3", None, "old"),
        ("C4", None, "old"),
    ]


def test_dossier(spark, claims):
    ids = spark.createDataFrame([("C1",), ("C1",), ("C2",), ("C77",)], "claim_id string")
    priority = spark.createDataFrame([("C2", 0.98765)], "claim_id string, manual_review_score double")
    got = serving.claim_dossier(ids, claims, priority).select("claim_id", "review_score")
    assert rows(got, "claim_id") == [("C1", None), ("C2", 0.988)]


def test_triage_queue(spark, claims):
    priority = spark.createDataFrame(
        [("C1", 0.99), ("C2", 0.5), ("C3", 0.5), ("C4", 0.66), ("C9", 1.0)], "claim_id string, manual_review_score double"
    )
    queue = serving.triage_queue(priority, claims)
    assert [(r.claim_id, r.tier) for r in queue.collect()] == [("C4", "high"), ("C2", "med"), ("C3", "med")]
    assert serving.triage_queue(priority, claims, 1).count() == 1


GOOD = '{"triage_score": 0.8, "risk_tier": "high", "next_action": "appeal_route", "rationale": "late filing"}'
REPLIES = [
    ("ok", GOOD, None),
    ("spaced", f"\n  {GOOD}\n", None),
    ("fenced", f"```json\n{GOOD}\n```", None),
    ("bare fence", f"```\n{GOOD}```", None),
    ("text score", GOOD.replace("0.8", '"0.8"'), None),
    ("null rationale", GOOD.replace('"late filing"', "null"), None),
    ("more keys", GOOD.replace("{", '{"extra": [1, {"a": 2}], '), None),
    ("edge score", GOOD.replace("0.8", "1.0"), None),
    ("missing", '{"triage_score": 0.8, "risk_tier": "high", "next_action": "none"}', "missing key"),
    ("action", GOOD.replace("appeal_route", "escalate"), "unknown action"),
    ("null action", GOOD.replace('"appeal_route"', "null"), "unknown action"),
    ("high", GOOD.replace("0.8", "1.7"), "score out of range"),
    ("nan", GOOD.replace("0.8", '"NaN"'), "score out of range"),
    ("words", GOOD.replace("0.8", '"very"'), "score out of range"),
    ("null score", GOOD.replace("0.8", "null"), "score out of range"),
    ("prose", "I think this should be appealed.", "not json"),
    ("list", "[1, 2]", "not json"),
    ("cut off", GOOD[:-20], "not json"),
    ("fence only", "```", "not json"),
    ("empty", "", "not json"),
    ("null", None, "not json"),
]


def test_replies(spark):
    frame_ = spark.createDataFrame([r[:2] for r in REPLIES], "claim_id string, reply string")
    judged = {r.claim_id: r.reason for r in replies.judge_replies(frame_).collect()}
    assert judged == {name: reason for name, _, reason in REPLIES}
    good, bad = replies.validate_replies(frame_)
    assert good.count() + bad.count() == len(REPLIES)
    assert good.where("claim_id = 'fenced'").first().asDict() == {
        "claim_id": "fenced",
        "triage_score": 0.8,
        "risk_tier": "high",
        "triage_action": "appeal_route",
        "rationale": "late filing",
    }
    assert bad.columns == ["claim_id", "reply", "reason"]


def test_state_never_rolls_back_on_equal_times(spark, claims, events):
    """Two events of one time, in one call, in two, and in the wrong order: the larger event stays."""
    state = serving.current_state(claims, events)
    made = {n: frame(spark, "disposition_events", [event(n, "C1", "2024-05-01T00:00:00", s)]) for n, s in ((21, "Paid"), (22, "Denied"))}
    at_once = serving.upsert_latest(state, made[21].union(made[22]))
    for first, second in ((21, 22), (22, 21)):
        twice = serving.upsert_latest(serving.upsert_latest(state, made[first]), made[second])
        assert rows(twice.where("claim_id = 'C1'").select("status", "last_event_id")) == [("Denied", "E22")]
        assert twice.exceptAll(at_once).isEmpty()
    assert rows(at_once.where("claim_id = 'C1'").select("claim_detail"))[0][0] is not None


def test_repeated_scores_and_inserts_have_one_winner(spark, claims, events):
    state = serving.current_state(claims, events)
    scores = spark.createDataFrame([("C1", 0.2, "none"), ("C1", 0.9, "appeal_route"), ("C2", 7e9, "none")], "claim_id string, triage_score double, triage_action string")
    after = serving.write_back(state, scores)
    assert after.count() == state.count()
    assert rows(after.where("claim_id <= 'C2'").select("claim_id", "triage_score", "triage_action"), "claim_id") == [
        ("C1", Decimal("0.9000"), "appeal_route"),
        ("C2", None, "none"),
    ]
    new = [claim(9, billed_amount=b) for b in (5.0, 3.0, 4.0)]
    offered = serving.current_state(frame(spark, "claims", new), events, None, F.lit("2024-01-01").cast("timestamp"))
    both = serving.insert_if_absent(state, offered.repartition(3))
    assert rows(both.where("claim_id = 'C9'").select("billed_amount")) == [(Decimal("3.00"),)]
