"""Changes of claim state as a stream: late and repeated events are refused as they come in, what moves a claim leaves."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from claimlens.operators.serving import latest_dispositions
from claimlens.streaming.dispositions import keep_table

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# times are microseconds here: values out of the state and values out of the stream compare alike
EVENT = "claim_id string, status string, last_disposition_ts long, last_event_id string"
CHANGE = "claim_id string, before string, status string, last_disposition_ts long, last_event_id string"
EVENT_NAMES = [field.split()[0] for field in EVENT.split(", ")]
CHANGE_NAMES = [field.split()[0] for field in CHANGE.split(", ")]


#: Claims are dealt into so many rows of state by the hash of their id: a row is a call or two from the executor to Python, and these,
#: not the claims, are what a large state costs. A stream keeps the number it was first started with.
SLICES = 1 << 16
SLICE = ", ".join(f"{field.split()[0]} array<{field.split()[1]}>" for field in EVENT.split(", "))


def _order(row) -> tuple:
    """(time, event id), a missing one first: the order ``latest_dispositions`` goes by."""
    at, event = row["last_disposition_ts"], row["last_event_id"]
    return at is not None, at, event is not None, event


def _by_claim(rows: Iterable[Sequence]) -> dict:
    """The newest of the rows of each claim."""
    newest = {}
    for values in rows:
        row = dict(zip(EVENT_NAMES, values))
        if row["claim_id"] not in newest or _order(row) > _order(newest[row["claim_id"]]):
            newest[row["claim_id"]] = row
    return newest


class Newest(StatefulProcessor):
    """One row of state a slice, the newest disposition of each of its claims; an event that is not newer leaves no trace."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("newest", SLICE)

    def _keep(self, newest: dict) -> None:
        # A list a column, not a list of rows: these are handed over without a conversion of each value.
        self._held.update(tuple([row[c] for row in newest.values()] for c in EVENT_NAMES))

    def _newest(self) -> dict:
        return _by_claim(zip(*self._held.get())) if self._held.exists() else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = _by_claim([row[c] for c in EVENT_NAMES] for row in rows)
        held = self._newest()
        moved = {claim: row for claim, row in best.items() if claim not in held or _order(row) > _order(held[claim])}
        if moved:
            self._keep(held | moved)
        for claim, row in moved.items():
            yield Row(*CHANGE_NAMES)(claim, held[claim]["status"] if claim in held else None, *(row[c] for c in EVENT_NAMES[1:]))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep(_by_claim(zip(*[initialState[c] for c in EVENT_NAMES])))

    def close(self) -> None:
        pass


def _newest_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a claim of each Arrow batch, so that a claim with a third of all events is not a third of the shuffle."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [("claim_id", "ascending"), ("last_disposition_ts", "ascending"), ("last_event_id", "ascending")]
        rows = batch.take(pc.sort_indices(batch, sort_keys=keys, null_placement="at_start"))
        codes = rows.column("claim_id").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        last = np.append(codes[1:] != codes[:-1], True)
        yield rows.filter(pa.array(last))


def _seed(state: DataFrame, slice_of: Column) -> DataFrame:
    """A row a slice: the columns of its claims as lists."""
    micros = F.unix_micros("last_disposition_ts").alias("last_disposition_ts")
    rows = state.select(slice_of, F.struct("claim_id", "status", micros, "last_event_id").alias("row"))
    return rows.groupBy("slice").agg(F.collect_list("row").alias("rows")).select("slice", *[F.col("rows")[c].alias(c) for c in EVENT_NAMES])


def transitions(stream: DataFrame, state: DataFrame | None = None, slices: int = SLICES) -> DataFrame:
    """(claim_id, before, status, last_disposition_ts, last_event_id): each move of a claim to a newer disposition.

    ``before`` is the status it had, null for a claim seen for the first time. Of the events of one micro-batch a claim
    moves to its newest; a late or repeated event, or one of a batch that runs again, gives nothing. ``state`` is what claims
    were before the stream (claim_id, status, last_disposition_ts, last_event_id; one row a claim): it seeds the state when the
    stream first starts. A time that cannot be read counts as the earliest.

    Events are reduced to one a claim and Arrow batch before the shuffle; the state is one row a slice of the claims, kept on disk by the
    executors, and a batch reads and writes the slices of its own claims only. ``slices`` may not change once the stream has begun.
    """
    at = F.unix_micros(F.col("disposition_ts").try_cast("timestamp"))
    events = stream.select(
        "claim_id", F.col("disposition").alias("status"), at.alias("last_disposition_ts"), F.col("event_id").alias("last_event_id")
    )
    slice_of = F.pmod(F.xxhash64("claim_id"), F.lit(slices)).cast("int").alias("slice")
    reduced = events.mapInArrow(_newest_of_batches, EVENT).select("*", slice_of)
    seed = None if state is None else _seed(state, slice_of).groupBy("slice")
    changes = reduced.groupBy("slice").transformWithState(
        statefulProcessor=Newest(), outputStructType=CHANGE, outputMode="Append", timeMode="None", initialState=seed
    )
    return changes.withColumn("last_disposition_ts", F.timestamp_micros("last_disposition_ts"))


def keep_transitions(
    stream: DataFrame, path: str, checkpoint: str, state: DataFrame | None = None, every: str | None = None
) -> StreamingQuery:
    """Append the changes to a Parquet table. State of this kind needs the RocksDB store, which is set for this query alone."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return keep_table(transitions(stream, state), path, checkpoint, every)
    finally:
        spark.conf.set(PROVIDER, before)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """(claim_id, status, last_disposition_ts, last_event_id): where the changes kept so far have left each claim."""
    rows = spark.read.parquet(path).selectExpr(
        "claim_id", "status as disposition", "last_disposition_ts as disposition_ts", "last_event_id as event_id"
    )
    return latest_dispositions(rows)
