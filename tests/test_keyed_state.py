"""State in buckets: the same rows as the plain operators, and only the touched buckets written; bucketed joins without a shuffle."""

import contextlib
import io
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from claimlens.operators import keyed_state, serving
from claimlens.plans import metrics
from claimlens.sources.bucketed import read_bucketed, write_bucketed
from claimlens.streaming import dispositions
from tests.conftest import claim, frame

def at():
    return F.lit("2000-01-01").cast("timestamp")


def event(n, claim_id, status, ts):
    return {"event_id": f"E{n:03d}", "claim_id": claim_id, "disposition": status, "disposition_ts": ts, "downstream_action_fired": True}


@pytest.fixture()
def state(spark):
    claims = frame(spark, "claims", [claim(k) for k in range(40)])
    events = frame(spark, "disposition_events", [event(k, f"C{k}", "Paid", "2001-01-05T00:00:00") for k in range(0, 40, 2)])
    return serving.current_state(claims, events, None, at())


def told(df):
    return sorted(map(repr, df.drop("updated_at").collect()))


def updates(spark):
    rows = [event(100 + k, f"C{k % 45}", ["Denied", "Paid", "Partially Paid"][k % 3], f"2001-01-{1 + k * 7 % 28:02d}T00:00:00") for k in range(60)]
    rows += [event(100, "C1", "Denied", None), event(900, None, "Paid", "2001-01-01T00:00:00"), *rows[:5]]
    return frame(spark, "disposition_events", rows)


def test_changes_in_any_split_give_the_upsert(spark, state, tmp_path):
    wanted = told(serving.upsert_latest(state, updates(spark).where("claim_id is not null")))  # no claim, no state
    for n in (1, 3):
        folder = str(tmp_path / f"state{n}")
        keyed_state.create_state(state, folder, buckets=8)
        assert told(keyed_state.read_state(spark, folder)) == told(state)
        for part in [*range(n), 0]:  # the first batch comes twice
            keyed_state.change_state(spark, folder, updates(spark).where(F.pmod(F.xxhash64("event_id", "disposition_ts"), F.lit(n)) == part), serving.upsert_latest)
        assert told(keyed_state.read_state(spark, folder)) == wanted
        assert keyed_state.snapshot(spark, folder).version == n + 1


def files(folder):
    return {os.path.join(a, f): os.path.getmtime(os.path.join(a, f)) for a, _, fs in os.walk(f"{folder}/data") for f in fs if f.endswith(".parquet")}


def test_only_touched_buckets_are_written(spark, state, tmp_path):
    folder = str(tmp_path / "state")
    before = keyed_state.create_state(state, folder, buckets=16)
    old, written = told(keyed_state.read_state(spark, folder)), files(folder)
    two = frame(spark, "disposition_events", [event(500, "C3", "Denied", "2002-01-01T00:00:00"), event(501, "C8", "Denied", "2002-01-01T00:00:00")])
    reader = keyed_state.read_state(spark, folder)
    change = keyed_state.change_state(spark, folder, two, serving.upsert_latest)
    after = keyed_state.snapshot(spark, folder)
    wanted = {r[0] for r in two.select(keyed_state.bucket_of("claim_id", 16)).distinct().collect()}
    assert set(change.touched) == wanted and change.version == after.version == 1
    assert {b for b in before.folders if before.folders[b] != after.folders[b]} == wanted
    new = set(files(folder)) - set(written)
    assert len(new) == len(wanted) and all(files(folder)[f] == t for f, t in written.items())
    assert told(reader) == old  # whoever began to read goes on with the version before
    assert told(keyed_state.lookup(spark, folder, ["C3", "C5", "none"])) == told(keyed_state.read_state(spark, folder).where("claim_id in ('C3', 'C5')"))
    read = {os.path.dirname(f.removeprefix("file://")) for f in keyed_state.lookup(spark, folder, ["C3"]).inputFiles()}
    assert len(read) == 1
    nothing = keyed_state.change_state(spark, folder, two.limit(0), serving.upsert_latest)
    assert nothing.touched == [] and nothing.version == 1


def test_inserts_and_scores(spark, state, tmp_path):
    folder = str(tmp_path / "state")
    there = state.where("claim_id < 'C2'").withColumn("triage_action", F.lit("kept"))
    keyed_state.create_state(there, folder, buckets=8)
    keyed_state.change_state(spark, folder, state, serving.insert_if_absent)
    assert told(keyed_state.read_state(spark, folder)) == told(serving.insert_if_absent(there, state))
    scores = spark.createDataFrame([("C1", 0.5), ("C1", 0.7), ("C30", 0.25), ("C99", 0.1)], "claim_id string, triage_score double")
    wanted = told(serving.write_back(keyed_state.read_state(spark, folder), scores))
    keyed_state.change_state(spark, folder, scores, serving.write_back)
    assert told(keyed_state.read_state(spark, folder)) == wanted


def test_a_failed_change_leaves_the_version_before(spark, state, tmp_path):
    folder = str(tmp_path / "state")
    keyed_state.create_state(state, folder, buckets=4)
    before = told(keyed_state.read_state(spark, folder))
    broken = lambda rows, changes: rows.withColumn("status", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception, match="stop"):
        keyed_state.change_state(spark, folder, updates(spark), broken)
    assert told(keyed_state.read_state(spark, folder)) == before and keyed_state.snapshot(spark, folder).version == 0
    now = keyed_state.snapshot(spark, folder)
    keyed_state.change_state(spark, folder, updates(spark), serving.upsert_latest)
    with pytest.raises(AnalysisException):  # a writer that started from the version before
        keyed_state._commit(spark, folder, keyed_state.Snapshot(now.version + 1, now.key, now.buckets, now.folders))


def test_a_change_writes_its_own_rows_only(spark, state, tmp_path, monkeypatch):
    """However large a bucket is: the other rows of it are neither written again nor shuffled."""
    folder = str(tmp_path / "state")
    keyed_state.create_state(state.repartition(1), folder, buckets=1)
    two = frame(spark, "disposition_events", [event(500, "C3", "Denied", "2002-01-01T00:00:00"), event(501, "C88", "Denied", "2002-01-01T00:00:00")])
    before = set(files(folder))
    keyed_state.change_state(spark, folder, two, serving.upsert_latest)
    new = spark.read.schema(state.schema).parquet(*(set(files(folder)) - before))
    assert sorted(r.claim_id for r in new.collect()) == ["C3", "C88"]
    assert told(keyed_state.read_state(spark, folder)) == told(serving.upsert_latest(state, two))
    base = keyed_state._read(spark, folder, [keyed_state.snapshot(spark, folder).folders[0][0][0]])
    monkeypatch.setattr(keyed_state, "_layers", lambda *_: [base])
    assert "Exchange hashpartitioning" not in plan_of(keyed_state._rows_of(spark, folder, keyed_state.snapshot(spark, folder), [0], two.select("claim_id"), 2))


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_many_changes_of_a_bucket(spark, state, tmp_path, monkeypatch, sent):
    """Keys changed again and again, repeated and missing keys in the state, and buckets that are written whole after some changes."""
    monkeypatch.setattr(keyed_state, "MAX_LAYERS", 2)
    monkeypatch.setattr(keyed_state, "BROADCAST_KEYS", sent)
    folder = str(tmp_path / "state")
    odd = state.unionByName(state.where("claim_id in ('C5', 'C6')")).unionByName(state.limit(1).withColumn("claim_id", F.lit(None).cast("string")))
    keyed_state.create_state(odd, folder, buckets=2)
    most, wanted, types = 0, odd, ", ".join(f"{name} {kind}" for name, kind in odd.dtypes)
    for k in range(3):
        ids = ["C5", "C6", f"C{10 + k}", f"new{k % 2}"]
        batch = frame(spark, "disposition_events", [event(600 + k, c, f"S{k}", f"2002-01-{1 + (k * 5) % 7:02d}T00:00:00") for c in ids])
        keyed_state.change_state(spark, folder, batch, serving.upsert_latest)
        wanted = spark.createDataFrame(serving.upsert_latest(wanted, batch).collect(), types)
        assert told(keyed_state.read_state(spark, folder)) == told(wanted)
        most = max(most, *map(len, keyed_state.snapshot(spark, folder).folders.values()))
        asked = ["C5", "new0", "C1", "none"]
        assert told(keyed_state.lookup(spark, folder, asked)) == told(wanted.where(F.col("claim_id").isin(asked)))
    assert most == 2


def test_an_empty_state_can_be_filled(spark, state, tmp_path):
    folder = str(tmp_path / "state")
    keyed_state.create_state(state.limit(0), folder)
    assert keyed_state.read_state(spark, folder).count() == 0 and keyed_state.read_state(spark, folder).columns == state.columns
    keyed_state.change_state(spark, folder, state, serving.insert_if_absent)
    assert told(keyed_state.read_state(spark, folder)) == told(state)


def test_streamed_batches_late_and_repeated(spark, state, tmp_path):
    folder, source = str(tmp_path / "state"), tmp_path / "source"
    keyed_state.create_state(state, folder, buckets=4)
    all_updates = updates(spark).where("claim_id is not null")
    parts = [all_updates.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k) for k in (2, 0, 1, 0)]
    for n, part in enumerate(parts):  # a file twice, and the checkpoint lost before the last
        part.coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(part.schema).parquet(str(source))
        dispositions.keep_keyed_state(stream, folder, str(tmp_path / f"checkpoint{n // 3}")).awaitTermination()
    assert told(keyed_state.read_state(spark, folder)) == told(serving.upsert_latest(state, all_updates))


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path, monkeypatch):
    claims = frame(spark, "claims", [claim(k, status=["Paid", "Denied"][k % 2]) for k in range(60)])
    events = frame(spark, "disposition_events", [event(k, f"C{k % 50}", "Paid", f"2001-01-{1 + k % 28:02d}T00:00:00") for k in range(90)])
    scores = spark.createDataFrame([(f"C{k}", k / 100) for k in range(60)], "claim_id string, manual_review_score double")
    a, b, c = (write_bucketed(df, str(tmp_path / n), "claim_id", 4) for df, n in ((claims, "claims"), (events, "events"), (scores, "scores")))
    again = [read_bucketed(spark, str(tmp_path / n), "claim_id", 4) for n in ("claims", "events", "scores")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for claims_, events_, scores_ in ((a, b, c), again):
            state = serving.current_state(claims_, events_, None, at())
            assert "SortMergeJoin" in plan_of(state) and "Exchange" not in plan_of(state)
            assert told(state) == told(serving.current_state(claims, events, None, at()))
            back = serving.write_back(state, scores_.withColumnRenamed("manual_review_score", "triage_score"))
            assert "Exchange" not in plan_of(back)
            joined = scores_.join(claims_, "claim_id")
            assert "Exchange" not in plan_of(joined)
            means = metrics.mean_score_by_status(scores_, claims_)
            assert plan_of(means).count("Exchange") == 1  # the grouping by status
            assert told_plain(means) == told_plain(metrics.mean_score_by_status(scores, claims))
        assert "Exchange" in plan_of(serving.current_state(claims, events, None, at()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def told_plain(df):
    return sorted(map(tuple, df.collect()))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(40_000).select(F.concat(F.lit("C"), "id").alias("claim_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("text"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed_state.create_state(rows, str(tmp_path / "state"), buckets=1)
        write_bucketed(rows, str(tmp_path / "bucketed"), "claim_id", 1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for files in ((tmp_path / "state" / "data").rglob("*.parquet"), (tmp_path / "bucketed").rglob("*.parquet")):
        spans = sorted(tuple(spark.read.parquet(str(f)).agg(F.min("claim_id"), F.max("claim_id")).first()) for f in files)
        assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # a range of keys a file
    assert keyed_state.read_state(spark, str(tmp_path / "state")).count() == 40_000
    back = read_bucketed(spark, str(tmp_path / "bucketed"), "claim_id", 1)
    assert back.groupBy("claim_id").count().count() == 40_000
