"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

# These train a hundred rounds; the model has tests of its own.
SLOW = {"review_priority", "review_score_checks", "trained_triage_checks", "quality_report"}
MAY_BE_EMPTY = {"member_cob_claims"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_same_as_sql(spark, sf_dir, name):
    wrong = difference(entry.queries()[name](spark, sf_dir), sf_dir, entry.oracle_sql()[name])
    if name in MAY_BE_EMPTY and wrong == "no rows":
        wrong = None
    assert wrong is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows_only(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.claims == 1500 and 0 < row.action_fired_rate < 1
