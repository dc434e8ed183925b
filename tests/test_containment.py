"""JSON containment against a plain version on random documents, on VARIANT columns and on parsed structs."""

import json
import random

from pyspark.sql import functions as F

from checks.queries import LINE_PATTERN
from claimlens import schemas
from claimlens.functions.nested import json_contains, parse_detail, variant_contains
from claimlens.operators import silver, variants
from tests.conftest import DETAIL, claim, frame, rows


def contains(value, pattern):
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(k in value and contains(value[k], v) for k, v in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(contains(x, p) for x in value) for p in pattern)
    if pattern is None or isinstance(pattern, (bool, str)):
        return type(value) is type(pattern) and value == pattern
    return isinstance(value, (int, float)) and not isinstance(value, bool) and value == pattern


def made(draw, depth=0):
    kind = draw.random()
    if depth < 4 and kind < (1 if depth == 0 else 0.35):
        return {k: made(draw, depth + 1) for k in draw.sample(["a", "b", "c", "d.e", "it's \"x\"", "line_items"], draw.randint(0, 4))}
    if depth < 4 and kind < 0.6:
        return [made(draw, depth + 1) for _ in range(draw.randint(0, 3))]
    return draw.choice([1, 1.0, 2.5, -3, 0.1, 10**12, "1", "x", "", "true", True, False, None])


def part_of(draw, value):
    """Something that is contained, or nearly."""
    if isinstance(value, dict):
        return {k: part_of(draw, v) for k, v in value.items() if draw.random() < 0.6}
    if isinstance(value, list):
        return [part_of(draw, x) for x in value if draw.random() < 0.6][::-1]
    return value if draw.random() < 0.9 else made(draw, 9)


def test_variant_containment_is_the_plain_one(spark):
    draw = random.Random(5)
    values = [made(draw) for _ in range(120)]
    patterns = [part_of(draw, draw.choice(values)) for _ in range(60)] + [{}, {"zz": 1}, {"a": []}, {"a": {}}, {"a": None}, {"line_items": [{"a": 1}, {}]}]
    docs = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(values)] + [(-1, "no json"), (-2, None), (-3, "7"), (-4, "[1]")], "id int, j string")
    value = docs.select("id", F.try_parse_json("j").alias("v"))
    hits = 0
    for start in range(0, len(patterns), 22):  # some patterns a job
        some = patterns[start : start + 22]
        got = value.select("id", *[variant_contains(F.col("v"), p).alias(f"p{k}") for k, p in enumerate(some)]).collect()
        for row in got:
            document = values[row["id"]] if row["id"] >= 0 else {-3: 7, -4: [1]}.get(row["id"], "unread")
            wanted = [document != "unread" and contains(document, p) for p in some]
            assert [row[f"p{k}"] for k in range(len(some))] == wanted, (document, some)
            hits += sum(wanted)
    assert hits > 300


def test_struct_containment_over_objects_in_lists(spark):
    docs = spark.createDataFrame([(DETAIL,), (None,), ("no json",)], "claim_detail string")
    asked = {
        "line": ({"line_items": [{"cpt": "99213"}]}, True),
        "two of one": ({"line_items": [{"cpt": "99213"}, {"units": 1}]}, True),
        "nested list": ({"line_items": [{"modifiers": ["LT"], "charge": 10.5}]}, True),
        "other": ({"line_items": [{"cpt": "99213", "units": 2}]}, False),
        "no such field": ({"line_items": [{"nothing": 1}]}, False),
        "no such path": ({"adjudication": {"copay": {"deep": 1}}}, False),
        "other kind": ({"line_items": [{"units": "1"}]}, False),
        "bool for number": ({"line_items": [{"units": True}]}, False),
        "none of a list": ({"line_items": []}, True),
        "list for object": ({"adjudication": []}, False),
        "flag": ({"adjudication": {"coordination_of_benefits": True, "edits_triggered": ["MUE"]}}, True),
    }
    parsed = parse_detail()
    got = docs.select(*[json_contains(parsed, p).alias(k) for k, (p, _) in asked.items()]).collect()
    assert got[0].asDict() == {k: wanted for k, (_, wanted) in asked.items()}
    assert not any(got[2].asDict().values())


def test_matches_over_lines_in_several_documents(spark):
    line = lambda n, **more: {"line": n, "cpt": "99214", "modifiers": ["25"], "units": 1, **more}
    edits = {"adjudication": {"edits_triggered": ["NCCI-PTP", "MUE"]}}
    told = {
        "C1": {"line_items": [line(1), line(2, units=3)], **edits},
        "C2": {"line_items": [line(1)], **edits},  # its line of three units is in a further document
        "C3": {"line_items": [line(1, cpt="99213"), line(2, units=3, modifiers=[])], **edits},
        "C4": {"line_items": [line(1), line(2, units=3)], "adjudication": {"edits_triggered": []}},
        "C5": {"line_items": [], **edits},  # all its lines are in further documents
    }
    claims = frame(spark, "claims", [claim(int(k[1]), claim_detail=json.dumps(v)) for k, v in told.items()] + [claim(6, claim_detail="no json"), claim(7, claim_detail=None)])
    further = [("C2", 1, {"line_items": [line(3, units=3, cpt="J1817")]}), ("C5", 1, {"line_items": [line(1)]}), ("C5", 2, {"line_items": [line(2, units=3)]})]
    more = spark.createDataFrame([(k, n, json.dumps(d)) for k, n, d in further], "claim_id string, part int, claim_detail string")
    text = silver.detail_matches(claims, LINE_PATTERN, more)
    stored = silver.detail_matches(variants.with_detail(claims), LINE_PATTERN, variants.with_detail(more))
    for found in (text, stored):
        assert sorted(r.claim_id for r in found.collect()) == ["C1", "C2", "C5"]
    assert text.columns == claims.columns
    assert [r.claim_id for r in silver.detail_matches(claims, LINE_PATTERN).collect()] == ["C1"]
    assert sorted(r.claim_id for r in silver.detail_matches(claims, {"line_items": []}, more).collect()) == ["C1", "C2", "C3", "C4", "C5"]


def test_details_parsed_at_load_give_the_parsed_tables(spark, tmp_path):
    odd = [claim(1), claim(2, claim_detail="no json"), claim(3, claim_detail=None), claim(4, claim_detail='{"line_items": null}'), claim(5, claim_detail='{"line_items": []}')]
    odd += [claim(6, claim_detail='{"line_items": [{"line": "x", "cpt": 7, "charge": 1}], "adjudication": {"copay": "much"}}')]
    claims = frame(spark, "claims", odd)
    more = spark.createDataFrame([("C1", 1, DETAIL), ("C5", 1, DETAIL)], schemas.CLAIM_DOCUMENTS)
    variants.write_details(claims, more, str(tmp_path))
    got = variants.read_details(spark, str(tmp_path))
    assert dict(got[0].dtypes)["detail"] == "variant"
    told = {r.claim_id: r for r in variants.variant_silver(*got).collect()}
    assert [told[f"C{k}"].line_count for k in range(1, 7)] == [2, None, None, None, 1, 1]
    assert (told["C1"].copay, told["C1"].edits_triggered, told["C1"].has_cob) == (5.25, ["MUE"], True)
    assert told["C6"].copay is None and told["C6"].has_cob is None
    lines = variants.variant_lines(*got).orderBy("claim_id").collect()
    assert [r.claim_id for r in lines] == ["C1", "C1", "C5", "C6"]
    assert lines[0].asDict() == silver.claim_lines(claims.where("claim_id = 'C1'"), more.limit(0)).first().asDict()
    assert (lines[3].line, lines[3].cpt, lines[3].charge) == (None, "7", 1.0)


def test_details_of_claims_in_order_are_parsed_in_place(spark, tmp_path):
    claims = frame(spark, "claims", [claim(k, member_id=f"M{k % 7}") for k in range(40)])
    more = spark.createDataFrame([("C1", 1, DETAIL)], schemas.CLAIM_DOCUMENTS)
    spark.sparkContext.setJobGroup("details", "details")
    variants.write_details(claims, more, str(tmp_path), in_order=True)
    stages = [spark.sparkContext.statusTracker().getJobInfo(j).stageIds for j in spark.sparkContext.statusTracker().getJobIdsForGroup("details")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and all(len(s) == 1 for s in stages)  # no shuffle
    got = variants.variant_lines(*variants.read_details(spark, str(tmp_path)))
    assert rows(got.select("claim_id", "line", "cpt"), "claim_id", "line") == rows(silver.claim_lines(claims, more).select("claim_id", "line", "cpt"), "claim_id", "line")
