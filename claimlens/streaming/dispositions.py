"""Disposition events as a stream: bronze table, open feed, current state, gap metric."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from claimlens import schemas
from claimlens.operators.keyed_state import change_state
from claimlens.operators.serving import latest_dispositions, upsert_latest
from claimlens.operators.silver import open_dispositions
from claimlens.plans.metrics import action_gap


def file_stream(
    spark: SparkSession, directory: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a directory as a stream, read with a given schema."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(directory)


def disposition_stream(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """Disposition events as they land."""
    return file_stream(spark, directory, schemas.DISPOSITION_EVENTS, files_per_batch=files_per_batch)


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Keep running at an interval, or, without one, run through what is there and end."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def keep_table(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table; the file sink's log makes each row land once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start(path)


def open_feed(stream: DataFrame) -> DataFrame:
    """Open dispositions out of the stream: stateless, so each leaves in the batch it lands in."""
    return open_dispositions(stream)


def keep_state(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the newest disposition per claim.

    A batch writes its own newest disposition per claim under its batch number, so the work of a
    batch grows with the batch and not with the state, and a batch run twice replaces its own rows.
    ``read_changes`` and ``read_state`` merge the batches by the same rule.
    """

    def changes(batch: DataFrame, number: int) -> None:
        latest_dispositions(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(changes).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def keep_keyed_state(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep a state in buckets (``keyed_state.create_state``) current: a batch writes the rows of its own claims.

    Late, repeated and re-run batches change nothing, as the larger (time, event id) wins whenever it comes.
    """

    def changes(batch: DataFrame, number: int) -> None:
        change_state(batch.sparkSession, path, batch, upsert_latest)

    writer = stream.writeStream.foreachBatch(changes).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def _folded(path: str) -> str:
    return f"{path.rstrip('/')}-folded"


def _last_fold(spark: SparkSession, path: str) -> int | None:
    """The last batch that is folded."""
    try:
        return spark.read.parquet(_folded(path)).agg(F.max("upto")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _changes(spark: SparkSession, path: str) -> DataFrame:
    """What the last fold and the batches after it hold; batches that are folded are not read."""
    batches, last = spark.read.parquet(path), _last_fold(spark, path)
    if last is None:
        return batches.drop("batch")
    newer = batches.where(F.col("batch") > last).drop("batch")
    return spark.read.parquet(f"{_folded(path)}/upto={last}").select(newer.columns).union(newer)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """(claim_id, status, last_disposition_ts, last_event_id): the newest disposition of each streamed claim."""
    rows = _changes(spark, path).selectExpr(
        "claim_id", "status as disposition", "last_disposition_ts as disposition_ts", "last_event_id as event_id"
    )
    return latest_dispositions(rows)


def read_state(spark: SparkSession, path: str, state: DataFrame) -> DataFrame:
    """The serving state as of now: ``state`` from before the stream, with everything streamed since."""
    rows = _changes(spark, path).selectExpr(
        "claim_id", "status as disposition", "last_disposition_ts as disposition_ts", "last_event_id as event_id"
    )
    return upsert_latest(state, rows)


def compact_state(spark: SparkSession, path: str) -> None:
    """Fold the batches written so far into one, next to them; readers take it from then on.

    The stream goes on writing its batches where it did, and its later batches are read on top of the fold, so nothing
    is missed whether or not it is running. Batches that are folded may be deleted once no reader is at them.
    """
    upto = spark.read.parquet(path).agg(F.max("batch")).first()[0]
    if _last_fold(spark, path) != upto:
        read_changes(spark, path).write.mode("overwrite").parquet(f"{_folded(path)}/upto={upto}")


def gap_stream(stream: DataFrame) -> DataFrame:
    """Dispositions and their action rate, kept current; the state is one row per disposition."""
    return action_gap(stream)


def keep_gap(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the gap metric after each batch under its batch number; the highest number is current."""

    def whole(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = gap_stream(stream).writeStream.outputMode("complete").foreachBatch(whole)
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start()


def read_gap(spark: SparkSession, path: str) -> DataFrame:
    """The gap metric as of the last batch."""
    batches = spark.read.parquet(path)
    return batches.where(F.col("batch") == batches.agg(F.max("batch")).scalar()).drop("batch")
