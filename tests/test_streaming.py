"""Streams against the batch answer, with late and repeated input."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimlens.operators.serving import current_state, latest_dispositions, upsert_latest
from claimlens.plans.metrics import action_gap
from checks import book
from claimlens.streaming import dispositions


@pytest.fixture(scope="module")
def updates(spark, sf_dir):
    made = book.derived_book(spark, sf_dir)["disposition_updates"]
    return made.withColumn("disposition_ts", F.col("disposition_ts").cast("string")).withColumn(
        "action_type", F.lit(None).cast("string")
    )


def land(updates, folder, part):
    """A third of the updates as new files."""
    number = F.substring("event_id", 2, 9).cast("int")
    updates.where(number % 3 == part).coalesce(1).write.mode("append").parquet(folder)


def test_state_with_late_and_repeated_events(spark, updates, tmp_path):
    folder, path, log = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "log")
    for part in (2, 0, 1, 1):
        land(updates, folder, part)
        dispositions.keep_state(dispositions.disposition_stream(spark, folder), path, log).awaitTermination()
    want = rows(latest_dispositions(updates), "claim_id")
    assert rows(dispositions.read_changes(spark, path), "claim_id") == want
    empty = dispositions.read_changes(spark, path).limit(0)
    assert rows(upsert_latest(empty, updates), "claim_id") == want


def test_batches_after_a_fold_are_read(spark, updates, tmp_path):
    folder, path, log = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "log")
    for part in (2, 0, 1):
        land(updates, folder, part)
        dispositions.keep_state(dispositions.disposition_stream(spark, folder), path, log).awaitTermination()
        want = rows(latest_dispositions(spark.read.parquet(folder)), "claim_id")
        assert rows(dispositions.read_changes(spark, path), "claim_id") == want
        dispositions.compact_state(spark, path)
        dispositions.compact_state(spark, path)
        assert rows(dispositions.read_changes(spark, path), "claim_id") == want


def test_streamed_state_equals_the_batch_state(spark, sf_dir, updates, tmp_path):
    made = book.derived_book(spark, sf_dir)
    claims = made["claims"].withColumn("claim_detail", F.lit("{}"))
    state = current_state(claims, made["disposition_events"], None, F.lit("2024-01-01").cast("timestamp"))
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    land(updates, folder, 0)
    land(updates, folder, 1)
    dispositions.keep_state(dispositions.disposition_stream(spark, folder), path, str(tmp_path / "log")).awaitTermination()
    streamed, batch = dispositions.read_state(spark, path, state), upsert_latest(state, spark.read.parquet(folder))
    assert streamed.columns == batch.columns and "claim_detail" in batch.columns
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_state_survives_a_rerun_batch(spark, updates, tmp_path):
    """A batch that ran but was not recorded runs again under its number and replaces its rows."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    land(updates, folder, 0)
    stream = dispositions.disposition_stream(spark, folder)
    dispositions.keep_state(stream, path, str(tmp_path / "log1")).awaitTermination()
    first = rows(spark.read.parquet(path), "claim_id")
    dispositions.keep_state(stream, path, str(tmp_path / "log2")).awaitTermination()
    assert rows(spark.read.parquet(path), "claim_id") == first


def test_bronze_and_open_feed(spark, updates, tmp_path):
    folder = str(tmp_path / "in")
    for part in (0, 1):
        land(updates, folder, part)
        stream = dispositions.disposition_stream(spark, folder, files_per_batch=1)
        dispositions.keep_table(stream, str(tmp_path / "bronze"), str(tmp_path / "log1")).awaitTermination()
        feed = dispositions.open_feed(stream)
        dispositions.keep_table(feed, str(tmp_path / "open"), str(tmp_path / "log2")).awaitTermination()
    landed = spark.read.parquet(folder)
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert bronze.count() == landed.count() and bronze.exceptAll(landed).isEmpty()
    still_open = spark.read.parquet(str(tmp_path / "open"))
    assert still_open.count() == landed.where("NOT downstream_action_fired").count() > 0


def test_gap_follows_the_stream(spark, updates, tmp_path):
    folder, path, log = str(tmp_path / "in"), str(tmp_path / "gap"), str(tmp_path / "log")
    for part in (0, 2):
        land(updates, folder, part)
        dispositions.keep_gap(dispositions.disposition_stream(spark, folder), path, log).awaitTermination()
        want = rows(action_gap(spark.read.parquet(folder)), "disposition")
        assert rows(dispositions.read_gap(spark, path), "disposition") == want


def test_state_kept_at_an_interval(spark, updates, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    land(updates, folder, 0)
    running = dispositions.keep_state(
        dispositions.disposition_stream(spark, folder), path, str(tmp_path / "log"), every="1 second"
    )
    try:
        running.processAllAvailable()
        land(updates, folder, 1)
        running.processAllAvailable()
    finally:
        running.stop()
    want = rows(latest_dispositions(spark.read.parquet(folder)), "claim_id")
    assert rows(dispositions.read_changes(spark, path), "claim_id") == want
