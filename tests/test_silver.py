from conftest import DETAIL, claim, frame, rows
from pyspark.sql import functions as F

from claimlens.functions.nested import detail_has_source, detail_parses, json_contains, parse_detail
from claimlens.operators import silver

EMPTY = '{"edi_source":"837","line_items":[],"adjudication":{"coordination_of_benefits":false}}'


def claims(spark):
    return frame(
        spark,
        "claims",
        [
            claim(1),
            claim(2, claim_detail=EMPTY, member_id="M2"),
            claim(3, claim_detail="{broken"),
            claim(4, claim_detail=None),
            claim(5, claim_detail='{"clearinghouse_id":"CH2"}'),
        ],
    )


def none(spark):
    return frame(spark, "claim_documents", [])


def test_silver_columns(spark):
    parsed = silver.claims_silver(claims(spark), none(spark)).select("claim_id", "line_count", "copay", "edits_triggered", "has_cob")
    assert rows(parsed, "claim_id") == [
        ("C1", 1, 5.25, ["MUE"], True),
        ("C2", 0, None, None, False),
        ("C3", None, None, None, None),
        ("C4", None, None, None, None),
        ("C5", None, None, None, None),
    ]


def test_detail_is_parsed_once(spark):
    plan = silver.claims_silver(claims(spark), none(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_detail_checks(spark):
    checked = claims(spark).select("claim_id", detail_parses().alias("parses"), detail_has_source().alias("source"))
    assert rows(checked, "claim_id") == [
        ("C1", True, True),
        ("C2", True, True),
        ("C3", False, False),
        ("C4", False, False),
        ("C5", True, False),
    ]


def test_lines_keep_every_field(spark):
    lines = silver.claim_lines(claims(spark), none(spark))
    assert rows(lines) == [("C1", 1, "99213", "d", 1, 10.5, ["25", "LT"], ["I10"], "0450")]
    kept = silver.claim_lines(claims(spark), none(spark), keep_empty=True)
    assert kept.count() == 5 and kept.where("line is null").count() == 4


def test_open_dispositions_drop_unknown_flags(spark):
    events = frame(
        spark,
        "disposition_events",
        [{"event_id": f"E{i}", "downstream_action_fired": f} for i, f in enumerate([True, False, None])],
    )
    assert [r.event_id for r in silver.open_dispositions(events).collect()] == ["E1"]


def test_json_contains(spark):
    one = spark.createDataFrame([(DETAIL,)], "claim_detail string")

    def holds(pattern):
        return one.select(json_contains(parse_detail(), pattern)).first()[0]

    assert holds({"adjudication": {"coordination_of_benefits": True}})
    assert holds({"edi_source": "837", "adjudication": {"cob_payer": "Medicare", "copay": 5.25}})
    assert holds({"adjudication": {"edits_triggered": ["MUE"]}})
    assert not holds({"adjudication": {"edits_triggered": ["MUE", "age-gender"]}})
    assert not holds({"adjudication": {"cob_payer": "Commercial"}})
    assert holds({})


def test_containment_on_broken_detail_is_false(spark):
    assert [r.claim_id for r in silver.cob_claims(claims(spark)).collect()] == ["C1"]


def test_member_lookup(spark):
    assert [r.claim_id for r in silver.member_cob_claims(claims(spark), "M1", none(spark)).collect()] == ["C1"]
    assert silver.member_cob_claims(claims(spark), "M2", none(spark)).isEmpty()


def test_denied_for_review_ties_and_limit(spark):
    made = [claim(i, status="Denied", requires_manual_review=1, billed_amount=float(b)) for i, b in enumerate([5, 9, 9, 1])]
    made.append(claim(8, status="Denied", requires_manual_review=0, billed_amount=99.0))
    top = silver.denied_for_review(frame(spark, "claims", made), none(spark), 3)
    assert [r.claim_id for r in top.collect()] == ["C1", "C2", "C0"]
    assert top.columns[-2:] == ["cob_payer", "line_count"]


def test_line_count_of_empty_array_is_zero(spark):
    assert claims(spark).where("claim_id = 'C2'").select(F.size(parse_detail().line_items)).first()[0] == 0
