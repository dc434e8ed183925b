"""Metric partials against the metric query, and records refused at load."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from claimlens.plans import metrics, partials
from claimlens.sources.tables import load_with_refusals
from tests.conftest import claim, frame

VIEW = metrics.CLAIMS_METRICS


def odd_claims(spark):
    made = [claim(k, status=["Paid", "Denied", "Pending", None][k % 4], billed_amount=k + 0.1 if k % 5 else None, requires_manual_review=[0, 1, None][k % 3]) for k in range(60)]
    made += [claim(100 + k, denial_reason=None, claim_type=None, status="Denied", billed_amount=None, requires_manual_review=None) for k in range(3)]
    return frame(spark, "claims", made)


def told(df):
    return sorted(map(repr, df.collect()))


def test_partials_give_the_metric_query_at_every_grain(spark, tmp_path):
    claims = odd_claims(spark)
    for k in (0, 1, 2, 1):
        partials.write_partials(VIEW, claims.where(F.pmod(F.xxhash64("claim_id"), F.lit(3)) == k), str(tmp_path), f"load{k}")
    for dims in ([], ["Status"], ["Claim Type", "rejection reason"], list(VIEW.dimensions)):
        for where in (None, F.col("Status") == "Denied", F.col("denial_reason").isNull() & (F.col("Claim Type") != "x"), F.lit(False)):
            got = partials.partial_query(spark, str(tmp_path), VIEW, dims, list(VIEW.measures), where)
            wanted = metrics.metric_query(VIEW, claims, dims, list(VIEW.measures), where)
            assert got.dtypes == wanted.dtypes and told(got) == told(wanted)


def test_a_load_touches_its_own_sums(spark, tmp_path):
    claims = odd_claims(spark)
    for k in ("a", "b"):
        partials.write_partials(VIEW, claims, str(tmp_path), k)
    files = lambda load: {f: os.path.getmtime(f"{tmp_path}/claims/load={load}/{f}") for f in os.listdir(f"{tmp_path}/claims/load={load}")}
    before = files("a")
    partials.write_partials(VIEW, claims.limit(0), str(tmp_path), "b")
    assert files("a") == before
    got = partials.partial_query(spark, str(tmp_path), VIEW, ["Status"], list(VIEW.measures))
    assert told(got) == told(metrics.metric_query(VIEW, claims, ["Status"], list(VIEW.measures)))


def test_other_filters_go_to_the_rows(spark, tmp_path):
    claims = odd_claims(spark)
    partials.write_partials(VIEW, claims, str(tmp_path), "a")
    where = F.col("billed_amount") > 30
    got = partials.partial_query(spark, str(tmp_path), VIEW, ["Status"], ["Claim Count"], where, lambda: claims)
    assert told(got) == told(metrics.metric_query(VIEW, claims, ["Status"], ["Claim Count"], where))
    with pytest.raises(AnalysisException):
        partials.partial_query(spark, str(tmp_path), VIEW, ["Status"], ["Claim Count"], where)
    with pytest.raises(KeyError):
        partials.partial_query(spark, str(tmp_path), VIEW, ["Status"], ["Paid Dollars"])
    with pytest.raises(metrics.PersonalColumnError):
        partials.partial_query(spark, str(tmp_path), VIEW, ["member_ssn"], ["Claim Count"])


def test_records_are_kept_or_refused_with_a_reason(spark, tmp_path):
    event = {"event_id": "E1", "claim_id": "C1", "disposition": "Paid", "disposition_ts": "2001-01-01T00:00:00", "downstream_action_fired": True, "action_type": None}
    lines = {
        json.dumps(event): None,
        json.dumps({**event, "extra": {"x": 1}}): None,
        json.dumps({"event_id": "E2"}): None,
        json.dumps({**event, "downstream_action_fired": "yes"}): "not of type: downstream_action_fired",
        json.dumps({**event, "downstream_action_fired": 1, "event_id": None}): "not of type: downstream_action_fired",
        json.dumps({**event, "event_id": None}): "no event_id",
        json.dumps(event)[:50]: "no record",
        "[1, 2]": "no record",
        "17": "no record",
        "plainly not": "no record",
        "{}": "no event_id",
    }
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.json").write_text("\n".join([*lines, "", "  "]))
    good, refused = load_with_refusals(spark, str(tmp_path / "in"), "disposition_events", "event_id")
    assert {r.record: r.reason for r in refused.collect()} == {k: v for k, v in lines.items() if v}
    assert sorted(r.event_id for r in good.collect()) == ["E1", "E1", "E2"] and refused.count() == 8
    assert good.dtypes == frame(spark, "disposition_events", []).dtypes
    numbers = tmp_path / "claims"
    numbers.mkdir()
    (numbers / "part.json").write_text('{"claim_id":"C1","billed_amount":"12.5","requires_manual_review":1}\n{"claim_id":"C2","billed_amount":12.5,"requires_manual_review":1.5}\n{"claim_id":"C3","billed_amount":12,"requires_manual_review":0}')
    good, refused = load_with_refusals(spark, str(numbers), "claims", "claim_id")
    assert [(r.claim_id, r.billed_amount) for r in good.collect()] == [("C3", 12.0)]
    assert sorted(r.reason for r in refused.collect()) == ["not of type: billed_amount", "not of type: requires_manual_review"]
