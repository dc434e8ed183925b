import pytest
from conftest import claim, frame, rows
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions.masks import register_masks
from claimlens.operators import governance, joins


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "members": frame(
            spark,
            "members",
            [
                {"member_id": "M1", "member_name": "Ann B", "member_ssn": "123-45-6789", "member_dob": "1970-02-03"},
                {"member_id": "M2", "member_name": "", "member_ssn": "678", "member_dob": "19"},
                {"member_id": None, "member_name": None, "member_ssn": None, "member_dob": None},
                {"member_id": "M1"},
            ],
        ),
        "providers": frame(spark, "providers", [{"provider_id": "P1", "specialty": "Radiology"}]),
        "claims": frame(spark, "claims", [claim(1), claim(2, member_id="M9"), claim(3, member_id=None)]),
        "disposition_events": frame(
            spark,
            "disposition_events",
            [
                {"event_id": "E1", "claim_id": "C1", "disposition": "Paid"},
                {"event_id": "E2", "claim_id": "C1", "disposition": "Denied"},
                {"event_id": "E3", "claim_id": "C7"},
                {"event_id": "E4", "claim_id": "C7"},
            ],
        ),
        "prior_authorizations": frame(spark, "prior_authorizations", []),
    }


def test_masks(spark, tables):
    masked = governance.members_for(tables["members"]).select("member_ssn", "member_name", "member_dob")
    assert sorted(rows(masked), key=str) == sorted(
        [
            ("XXX-XX-6789", "A*** ***", "1970-XX-XX"),
            ("XXX-XX-678", "*** ***", "19-XX-XX"),
            (None, None, None),
            (None, None, None),
        ],
        key=str,
    )
    clear = governance.members_for(tables["members"], {schemas.PHI_READERS, "others"})
    assert clear.where("member_ssn = '123-45-6789'").count() == 1
    register_masks(spark)
    assert spark.sql("SELECT mask_ssn('123-45-6789')").first()[0] == "XXX-XX-6789"


def test_mask_report_counts_clear_values(tables):
    assert rows(governance.mask_report(tables["members"]).select("column_name", "row_count", "unmasked"), "column_name") == [
        ("member_dob", 4, 2),
        ("member_name", 4, 2),
        ("member_ssn", 4, 2),
    ]
    assert governance.mask_report(governance.members_for(tables["members"])).where("unmasked > 1").isEmpty()


def test_primary_keys(tables):
    checked = governance.check_primary_keys(tables).select("table_name", "row_count", "null_keys", "duplicate_keys")
    assert rows(checked, "table_name") == [
        ("claims", 3, 0, 0),
        ("disposition_events", 4, 0, 0),
        ("members", 4, 1, 1),
        ("prior_authorizations", 0, 0, 0),
        ("providers", 1, 0, 0),
    ]


def test_foreign_keys(tables):
    checked = governance.check_foreign_keys(tables).select("constraint_name", "orphan_rows", "orphan_keys")
    assert rows(checked, "constraint_name") == [
        ("claims_member_fk", 2, 2),
        ("claims_provider_fk", 0, 0),
        ("disp_claim_fk", 2, 1),
        ("pa_member_fk", 0, 0),
        ("pa_provider_fk", 0, 0),
    ]
    report = governance.constraint_report(tables)
    assert report.count() == 10 and report.agg(F.sum("violations")).first()[0] == 6


def test_listings(spark):
    listed = governance.constraint_listing(spark)
    assert listed.count() == 10
    assert rows(listed.groupBy("constraint_type").count(), "constraint_type") == [("FOREIGN KEY", 5), ("PRIMARY KEY", 5)]
    columns = governance.column_listing(spark)
    tagged = columns.where("data_class = 'phi' AND pii = 'true'")
    assert [r.column_name for r in tagged.orderBy("column_name").collect()] == ["member_dob", "member_name", "member_ssn"]
    assert "charge" in columns.where("table_name = 'claims' AND column_name = 'billed_amount'").first().synonyms
    assert rows(governance.table_listing(spark).select("table_name", "tag", "value"), "table_name", "tag") == [
        ("claims", "certified", "true"),
        ("claims", "domain", "claims"),
        ("disposition_events", "domain", "claims_ops"),
    ]


def test_column_inventory_reads_the_metadata_the_tables_carry(spark):
    schema = "claim_id string, billed_amount double, `a.b` int"
    made = spark.createDataFrame([("C1", None, None), ("C1", 2.0, None), (None, None, 1)], schema)
    tables = {"claims": governance.describe(made, "claims"), "members": made.limit(0)}
    got = {(r.table_name, r.column_name): r for r in governance.column_inventory(tables).collect()}
    assert len(got) == 6
    billed = got["claims", "billed_amount"]
    assert (billed.comment, billed.synonyms, billed.row_count, billed.null_count) == ("Dollars the provider asked for.", "charge, submitted amount", 3, 2)
    assert got["members", "billed_amount"].comment is None and got["members", "billed_amount"].row_count == 0
    assert (got["claims", "a.b"].null_count, got["claims", "claim_id"].null_count, got["members", "a.b"].null_count) == (2, 1, 0)
    ssn = governance.describe(spark.createDataFrame([("1",)], "member_ssn string"), "members")
    assert governance.column_inventory({"members": ssn}).first().data_class == "phi"
    assert governance.column_inventory({"members": ssn.withColumn("member_ssn", F.upper("member_ssn"))}).first().pii is None
    tagged = rows(governance.tagged_tables(tables).select("tag", "value", "row_count"), "tag")
    assert tagged == [("certified", "true", 3), ("domain", "claims", 3)]


def test_declared_join(tables):
    whole = joins.join_declared(tables, ("claims", joins.join_declared(tables, "claims", "members")), "providers")
    assert {"plan_type", "specialty"} <= set(whole.columns)
    assert sorted(r.claim_id for r in whole.collect()) == ["C1", "C1"]  # M1 is there twice
    with pytest.raises(ValueError):
        joins.join_declared(tables, "members", "providers")


def test_left_join_from_the_one_side_keeps_every_parent(tables):
    joined = joins.join_declared(tables, "claims", "disposition_events", "left")
    assert rows(joined.select("claim_id", "event_id"), "claim_id", "event_id") == [
        ("C1", "E1"),
        ("C1", "E2"),
        ("C2", None),
        ("C3", None),
    ]
    plain = tables["claims"].join(tables["disposition_events"], "claim_id", "left").select(joined.columns)
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("left, right", [("claims", "disposition_events"), ("disposition_events", "claims")])
def test_outer_joins_equal_plain_ones(tables, left, right, how):
    joined = joins.join_declared(tables, left, right, how)
    plain = tables[left].join(tables[right], "claim_id", how).select(joined.columns)
    assert joined.count() == plain.count() and joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_orphans_with_a_hot_parent_key(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)] * 50, "k string")
    assert rows(joins.orphans(child, "k", parent, "k"), "k") == [(None, 1), ("b", 2)]
