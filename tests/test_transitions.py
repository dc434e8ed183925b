"""The stream of changes against a walk over the events in plain Python."""

from conftest import rows
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.operators.serving import latest_dispositions
from claimlens.streaming import dispositions, transitions

KINDS = ("Paid", "Denied", "Pending")


def event(n, claim, at, kind):
    made = {"event_id": n, "claim_id": claim, "disposition": kind, "disposition_ts": at}
    return tuple(made.get(f.name) for f in schemas.DISPOSITION_EVENTS.fields)


def land(spark, folder, events):
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.DISPOSITION_EVENTS.fields)
    spark.createDataFrame(events, types).coalesce(1).write.mode("append").parquet(folder)


def order(e):
    at, n = e[2], e[0]
    return (at is not None, at or "", n is not None, n or "")


def walk(held, batch):
    """What a batch changes: each claim moves to its newest event if that beats what is held."""
    newest = {}
    for e in batch:
        if e[1] not in newest or order(e) > order(newest[e[1]]):
            newest[e[1]] = e
    out = []
    for claim, e in newest.items():
        if claim not in held or order(e) > order(held[claim]):
            out.append((claim, held[claim][3] if claim in held else None, e[3], e[2], e[0]))
            held[claim] = e
    return out


def kept(spark, path):
    at = F.date_format("last_disposition_ts", "yyyy-MM-dd HH:mm:ss")
    return sorted(map(tuple, spark.read.parquet(path).withColumn("last_disposition_ts", at).collect()), key=repr)


def days(k, n):
    """Events of 40 claims, one of them with half of the rows; some without a time or an id."""
    made = []
    for i in range(n):
        claim = "hot" if i % 2 else f"c{(i * 7 + k) % 40}"
        at = None if i % 11 == 0 else f"2024-0{1 + (i * 5 + k) % 9}-{10 + (i + k) % 18} 0{i % 10}:00:00"
        made.append((None if i % 13 == 0 else f"e{k}-{i:05d}", claim, at, KINDS[(i + k) % 3]))
    return made


def test_changes_by_batch_with_late_and_repeated_events(spark, tmp_path):
    folder, path, log = str(tmp_path / "in"), str(tmp_path / "changes"), str(tmp_path / "log")
    held, want, landed = {}, [], []
    for batch in (days(2, 300), days(0, 300), days(2, 300), [("e9", None, "2024-12-01 00:00:00", "Paid")]):
        land(spark, folder, [event(*e) for e in batch])
        transitions.keep_transitions(dispositions.disposition_stream(spark, folder), path, log).awaitTermination()
        want += walk(held, batch)
        landed += batch
        assert kept(spark, path) == sorted(want, key=repr)
    newest = latest_dispositions(spark.read.parquet(folder))
    assert rows(transitions.read_newest(spark, path), "claim_id") == rows(newest, "claim_id")


def test_state_from_before_the_stream(spark, tmp_path):
    folder, path, log = str(tmp_path / "in"), str(tmp_path / "changes"), str(tmp_path / "log")
    first, later = days(5, 200), days(6, 200)
    held = {}
    walk(held, first)
    land(spark, str(tmp_path / "old"), [event(*e) for e in first])
    state = latest_dispositions(spark.read.parquet(str(tmp_path / "old")))
    land(spark, folder, [event(*e) for e in later])
    stream = dispositions.disposition_stream(spark, folder)
    transitions.keep_transitions(stream, path, log, state).awaitTermination()
    want = walk(held, later)
    assert want and kept(spark, path) == sorted(want, key=repr)
    # started again with the same state: it is not taken a second time
    land(spark, folder, [event(*e) for e in first])
    transitions.keep_transitions(stream, path, log, state).awaitTermination()
    assert kept(spark, path) == sorted(want + walk(held, first), key=repr)


def test_batches_are_reduced_before_the_shuffle():
    import pyarrow as pa

    names = transitions.EVENT_NAMES
    made = pa.RecordBatch.from_pylist(
        [
            dict(zip(names, r))
            for r in [("a", "x", None, "1"), ("a", "y", 5, None), ("a", "z", 5, "0"), (None, "p", 1, "1"), (None, "q", 0, "2")]
        ],
        pa.schema([("claim_id", pa.string()), ("status", pa.string()), ("last_disposition_ts", pa.int64()), ("last_event_id", pa.string())]),
    )
    out = [r for b in transitions._newest_of_batches(iter([made, made.slice(0, 0)])) for r in b.to_pylist()]
    assert sorted((r["claim_id"] or "", r["status"]) for r in out) == [("", "p"), ("a", "z")]


def test_other_streams_keep_their_state_store(spark, tmp_path):
    before = spark.conf.get(transitions.PROVIDER)
    land(spark, str(tmp_path / "in"), [event("e1", "a", "2024-01-01 00:00:00", "Paid")])
    stream = dispositions.disposition_stream(spark, str(tmp_path / "in"))
    transitions.keep_transitions(stream, str(tmp_path / "t"), str(tmp_path / "log")).awaitTermination()
    assert spark.conf.get(transitions.PROVIDER) == before != transitions.ROCKS


def test_claims_share_rows_of_state(spark, tmp_path):
    """A state of many claims is handed to the stream in slices, and claims of a slice move each on its own."""
    folder, path, log = str(tmp_path / "in"), str(tmp_path / "changes"), str(tmp_path / "log")
    first, later, last = days(5, 200), days(6, 200), days(1, 200)
    held = {}
    walk(held, [(n, c, t, k) for n, c, t, k in first if n is not None])
    land(spark, str(tmp_path / "old"), [event(*e) for e in first if e[0] is not None])
    state = latest_dispositions(spark.read.parquet(str(tmp_path / "old")))
    for batch in (later, last):
        land(spark, folder, [event(*e) for e in batch])
        moves = transitions.transitions(dispositions.disposition_stream(spark, folder), state, slices=3)
        before = spark.conf.get(transitions.PROVIDER)
        spark.conf.set(transitions.PROVIDER, transitions.ROCKS)
        try:
            dispositions.keep_table(moves, path, log).awaitTermination()
        finally:
            spark.conf.set(transitions.PROVIDER, before)
        if batch is later:
            want = walk(held, later)
            rows_of_state = spark.read.format("statestore").option("path", log).option("stateVarName", "newest").load()
            assert rows_of_state.count() == 3
    assert kept(spark, path) == sorted(want + walk(held, last), key=repr)


def test_seed_is_a_row_a_slice(spark):
    rows_ = [(f"c{k}" if k else None, "Paid", None, None if k % 2 else f"e{k}") for k in range(1000)]
    state = spark.createDataFrame(rows_, "claim_id string, status string, last_disposition_ts timestamp, last_event_id string")
    seed = transitions._seed(state, (F.pmod(F.xxhash64("claim_id"), F.lit(7))).alias("slice")).collect()
    assert len(seed) == 7
    told = [r for s in seed for r in zip(*(s[c] for c in transitions.EVENT_NAMES), strict=True)]
    assert sorted(told, key=repr) == sorted(rows_, key=repr)
