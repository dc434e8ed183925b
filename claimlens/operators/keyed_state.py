"""State by key in hash buckets: a change lays the rows of its own keys over the buckets they fall in, readers take each key's newest rows."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1_000_000


#: Layers of a bucket. A change that finds so many writes the bucket whole, as one layer.
MAX_LAYERS = 8
#: Keys that are sent to the rows, of about 100 bytes each in memory; where there are more, the join is left to Spark.
BROADCAST_KEYS = 1_000_000


@dataclass(frozen=True)
class Snapshot:
    """One version of a state: the layers of each bucket that has rows, the oldest first, a folder and its number of rows each.

    All rows of a key are in the last layer that has the key; what earlier ones say of it no longer counts.
    """

    version: int
    key: str
    buckets: int
    folders: dict[int, list[tuple[str, int]]]


@dataclass(frozen=True)
class Change:
    """What a change did: the version it made, and the buckets it wrote to."""

    version: int
    touched: list[int]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The newest version. Its log entry names every bucket, so no other entry is read; its size is the number of buckets."""
    log = spark.read.parquet(f"{path}/log")
    rows = log.where(F.col("version") == log.agg(F.max("version")).scalar()).collect()
    folders = {r["bucket"]: [(f["folder"], f["rows"]) for f in r["folders"]] for r in rows if r["folders"]}
    return Snapshot(rows[0]["version"], rows[0]["key"], rows[0]["buckets"], folders)


def _commit(spark: SparkSession, path: str, new: Snapshot) -> None:
    """Make a version current. Two writers cannot both make the same one: the second finds it there and fails."""
    rows = [(b, new.folders.get(b), new.key, new.buckets) for b in range(new.buckets)]
    entry = spark.createDataFrame(rows, "bucket int, folders array<struct<folder string, rows long>>, key string, buckets int").coalesce(1)
    entry.write.mode("errorifexists").parquet(f"{path}/log/version={new.version}")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> dict[int, list[tuple[str, int]]]:
    """Rows by bucket in a folder of their own; what a failed try leaves there is in no log entry and is never read.

    Ranges of the key cut through a large bucket, so that no task has to sort a whole one; each file holds one range of keys.
    Pages are packed by zstd, as those of other tables are.
    """
    folder = f"{path}/data/{uuid.uuid4().hex}"
    placed = rows.withColumn("bucket", bucket_of(key, buckets))
    laid = placed.repartitionByRange("bucket", key).sortWithinPartitions("bucket", key)
    laid.write.option("compression", "zstd").partitionBy("bucket").parquet(folder)
    written = rows.sparkSession.read.schema("bucket int").parquet(folder)
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a bucket
    return {r["bucket"]: [(f"{folder}/bucket={r['bucket']}", r["n"])] for r in counts}


def create_state(state: DataFrame, path: str, key: str = "claim_id", buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> Snapshot:
    """Lay ``state``, one row a key, out below ``path``. Without a number of buckets it follows from the number of rows."""
    spark = state.sparkSession
    buckets = buckets or max(8, math.ceil(state.count() / rows_per_bucket))
    state.limit(0).write.parquet(f"{path}/columns")
    new = Snapshot(0, key, buckets, _write(state, path, key, buckets))
    _commit(spark, path, new)
    return new


def _read(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    columns = spark.read.parquet(f"{path}/columns")
    return spark.read.schema(columns.schema).parquet(*folders) if folders else columns


def _layers(spark: SparkSession, path: str, now: Snapshot, buckets: Sequence[int]) -> list[DataFrame]:
    """The rows of the buckets by layer, the oldest first."""
    stacks = [now.folders[b] for b in buckets if b in now.folders]
    many = max((len(stack) for stack in stacks), default=1)
    return [_read(spark, path, [stack[k][0] for stack in stacks if k < len(stack)]) for k in range(many)]


def _sent(keys: DataFrame, many: int) -> DataFrame:
    """``keys``, to be sent to the rows where they are not too many: rows are wide, and stay where they are then."""
    return F.broadcast(keys) if many <= BROADCAST_KEYS else keys


def _whole(spark: SparkSession, path: str, now: Snapshot, buckets: Sequence[int]) -> DataFrame:
    """All rows of the buckets that count."""
    first, *later = _layers(spark, path, now, buckets)
    if not later:
        return first
    columns, key = first.columns, now.key
    numbered = [rows.withColumn("_layer", F.lit(k)) for k, rows in enumerate(later)]
    every = reduce(DataFrame.unionByName, numbered)
    newest = every.groupBy(key).agg(F.max("_layer").alias("_layer"))
    many = sum(n for b in buckets for _, n in now.folders.get(b, [])[1:])
    if many > BROADCAST_KEYS:  # a key may be in several layers
        many = newest.count()
    kept = first.join(_sent(newest.select(key), many), key, "left_anti").select(columns)
    return kept.unionByName(every.join(newest, [key, "_layer"], "left_semi").select(columns))


def _rows_of(spark: SparkSession, path: str, now: Snapshot, buckets: Sequence[int], keys: DataFrame, many: int) -> DataFrame:
    """The rows that count of ``keys`` in the buckets."""
    layers = _layers(spark, path, now, buckets)
    found = [rows.join(_sent(keys, many), now.key, "left_semi").select(rows.columns) for rows in layers]
    if len(found) == 1:
        return found[0]
    every = reduce(DataFrame.unionByName, [rows.withColumn("_layer", F.lit(k)) for k, rows in enumerate(found)])
    newest = F.max("_layer").over(Window.partitionBy(now.key))
    return every.withColumn("_newest", newest).where("_layer = _newest").select(layers[0].columns)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest version, whole. A reader keeps the version it began with while later ones are written."""
    now = snapshot(spark, path)
    return _whole(spark, path, now, list(now.folders))


def lookup(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The rows of a few keys; only the buckets they fall in are read, of these the layer that counts, and in it the row groups that can
    hold them."""
    now = snapshot(spark, path)
    asked = spark.createDataFrame([(k,) for k in keys if k is not None], f"{now.key} string")
    fall = {r[now.key]: r["bucket"] for r in asked.withColumn("bucket", bucket_of(now.key, now.buckets)).collect()}  # the asked keys
    held = {}  # folder -> the keys whose rows there count
    layered = sorted({b for b in fall.values() if len(now.folders.get(b, [])) > 1})
    if layered:
        theirs = [k for k, b in fall.items() if b in layered]
        layers = [
            rows.where(F.col(now.key).isin(theirs)).select(now.key, F.lit(k).alias("layer")) for k, rows in enumerate(_layers(spark, path, now, layered))
        ]
        for r in reduce(DataFrame.unionByName, layers).groupBy(now.key).agg(F.max("layer").alias("layer")).collect():
            held.setdefault(now.folders[fall[r[now.key]]][r["layer"]][0], []).append(r[now.key])
    for k, b in fall.items():
        if len(now.folders.get(b, [])) == 1:
            held.setdefault(now.folders[b][0][0], []).append(k)
    found = [_read(spark, path, [folder]).where(F.col(now.key).isin(some)) for folder, some in held.items()]
    return reduce(DataFrame.unionByName, found) if found else _read(spark, path, [])


def change_state(spark: SparkSession, path: str, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Change:
    """Apply ``merge(rows, changes)`` to the rows that have a key of ``changes``, and make the result current.

    ``merge`` is ``upsert_latest``, ``insert_if_absent``, ``write_back`` or another function that changes only keys of
    ``changes``. What it gives is laid over the buckets the keys fall in, as a layer of these rows alone, so a change writes and moves
    as much as it changes; buckets without such a key are neither read nor written. A bucket of no more than twice as many rows as it
    has changed keys, or of ``MAX_LAYERS`` layers, is written whole. Rows of ``changes`` without a key are of no claim and
    are left out (``orphan_checks`` counts them). A change that fails leaves the version
    before it; one that is applied again changes nothing, since these functions do not.
    """
    now = snapshot(spark, path)
    changes = changes.where(F.col(now.key).isNotNull()).persist()
    try:
        keys = changes.select(now.key).distinct()
        counts = keys.groupBy(bucket_of(now.key, now.buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a bucket at most
        asked = {r["bucket"]: r["n"] for r in counts}
        touched = sorted(asked)
        if not touched:
            return Change(now.version, [])
        stacks = {b: now.folders.get(b, []) for b in touched}
        whole = [b for b, stack in stacks.items() if len(stack) >= MAX_LAYERS or sum(n for _, n in stack) <= 2 * asked[b]]
        laid = [b for b in touched if b not in set(whole)]
        rows = _whole(spark, path, now, whole)
        if laid:
            rows = rows.unionByName(_rows_of(spark, path, now, laid, keys, sum(asked.values())))
        made = _write(merge(rows, changes).select(rows.columns), path, now.key, now.buckets)
    finally:
        changes.unpersist()
    over = {b: ([] if b in set(whole) else stacks[b]) + made.get(b, []) for b in touched}
    _commit(spark, path, Snapshot(now.version + 1, now.key, now.buckets, now.folders | over))
    return Change(now.version + 1, touched)
