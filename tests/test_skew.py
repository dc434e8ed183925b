"""A third of the rows under one key: one order, one member, one provider, one claim of updates.

Broadcasts are off and the skew thresholds tiny, so the joins take the paths of large tables.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import RAW, difference
from claimlens.operators.joins import join_declared

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
QUERIES = """claims_silver claim_lines hybrid_rows cob_claims features current_state current_state_all insert_if_absent
latest_state latest_updates stream_state claim_dossier orphan_checks update_orphans key_checks constraint_report
claims_members_providers events_with_claims narratives mean_score_by_status triage_queue score_writeback
keyword_top30 vector_top30 hybrid_search stored_line_counts written_claims stream_changes""".split()


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    changes = {
        "orders": "replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey)",
        "lineitem": "replace (case when row_number() over () % 3 = 0 then 5 else l_orderkey end as l_orderkey, "
        "case when l_partkey % 3 = 0 then 2 else l_suppkey end as l_suppkey)",
        "events": "replace (case when event_id % 3 = 0 then 11 else user_id end as user_id)",
    }
    for name in RAW:
        source = f"'{sf_dir}/{name}.parquet'"
        duckdb.sql(f"copy (select * {changes.get(name, '')} from {source}) to '{folder}/{name}.parquet'")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield folder
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql_on_skewed_tables(spark, skewed, name):
    assert difference(entry.queries()[name](spark, skewed), skewed, entry.oracle_sql()[name]) is None


def test_hot_parent_is_split_at_run_time(spark, skewed):
    """One member with a third of the claims, read from many files: its partition is cut up."""
    many = spark.range(0, 30000, numPartitions=8)
    claims = many.select(
        F.concat(F.lit("C"), "id").alias("claim_id"),
        F.when(F.col("id") % 3 == 0, "M1").otherwise(F.concat(F.lit("M"), F.col("id") % 3000)).alias("member_id"),
    )
    members = spark.range(3000).select(F.concat(F.lit("M"), "id").alias("member_id"), F.lit("PPO").alias("plan_type"))
    joined = join_declared({"claims": claims, "members": members}, "claims", "members")
    assert len(joined.collect()) == 30000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
