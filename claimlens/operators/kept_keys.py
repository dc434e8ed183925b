"""Declared keys checked batch by batch: a batch meets the keys kept so far, not the rows of the book."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import schemas

BUCKETS = 64
_KEYS = "side string, key string, n long, load string, bucket int"
_LOG = "constraint_name string, row_count long, null_keys long, duplicate_keys long, orphan_rows long, orphan_keys long, load string"


def _sides() -> list[tuple[str, str]]:
    """The (table, column) pairs that some declared key is about, once each."""
    pairs = [(k.table, k.column) for k in schemas.PRIMARY_KEYS] + [(k.table, k.column) for k in schemas.FOREIGN_KEYS]
    return list(dict.fromkeys(pairs))


def _name(table: str, column: str) -> str:
    return f"{table}.{column}"


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException:  # nothing is kept yet
        return spark.createDataFrame([], ddl)


def _key_counts(batch: Mapping[str, DataFrame]) -> DataFrame | None:
    """(side, key, n, bucket): rows of the batch by key, one row a key however many rows hold it; null keys too."""
    frames = [
        batch[table].groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(_name(table, column)).alias("side"), "key", "n")
        for table, column in _sides()
        if table in batch
    ]
    if not frames:
        return None
    return reduce(DataFrame.unionByName, frames).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))


def loads(spark: SparkSession, folder: str) -> set[str]:
    """The loads whose keys count: one name a load."""
    return {r["load"] for r in _read(spark, f"{folder}/log", _LOG).select("load").distinct().collect()}


def check_batch(spark: SparkSession, folder: str, load: str, batch: Mapping[str, DataFrame]) -> DataFrame:
    """Takes the rows of one load (table name to rows) into the kept keys; returns its changes of the violations.

    Kept are (key, rows) of every declared key column in hash buckets, a folder a load. Only the buckets that the
    batch's keys fall into are read, and only keys are. A key is surplus from its second row on, whichever load brings it; a
    foreign key is an orphan until some load brings its parent, which takes the orphans back. The log entry, one row a
    constraint, is written last and makes the load count: a load that failed before it can be run again, and one that
    is in the log changes nothing. One writer at a time. Null keys are counted for primary keys and are one orphan key.
    """
    log = _read(spark, f"{folder}/log", _LOG)
    done = loads(spark, folder)
    if load in done:
        return log.where(F.col("load") == load).drop("load")
    counts = _key_counts(batch)
    if counts is None:
        raise ValueError("the batch holds no table with a declared key")
    here = f"{folder}/keys/load={load}"
    counts.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(here)  # one file a bucket
    mine = _read(spark, here, "side string, key string, n long, bucket int")
    touched = [r["bucket"] for r in mine.select("bucket").distinct().collect()]  # at most BUCKETS numbers
    kept = _read(spark, f"{folder}/keys", _KEYS).where(F.col("load").isin(sorted(done)) & F.col("bucket").isin(touched))
    both = (
        kept.select("side", "key", F.col("n").alias("old"), F.lit(0).cast("long").alias("new"))
        .unionByName(mine.select("side", "key", F.lit(0).cast("long").alias("old"), F.col("n").alias("new")))
        .groupBy("side", "key")
        .agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    )
    _changes(both).withColumn("load", F.lit(load)).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    return _read(spark, f"{folder}/log", _LOG).where(F.col("load") == load).drop("load")


def _changes(both: DataFrame) -> DataFrame:
    """What the new rows change, from (side, key, old, new): one row a constraint.

    Each key is one row here, with the counts of all the columns it may stand in, so parents meet children without a join.
    """
    sides = {pair: k for k, pair in enumerate(_sides())}
    by_key = both.groupBy("key").pivot("side", [_name(*pair) for pair in sides]).agg(F.struct(F.first("old").alias("old"), F.first("new").alias("new")))
    count = lambda pair, what: F.coalesce(F.col(f"`{_name(*pair)}`")[what], F.lit(0))
    null = F.col("key").isNull()
    zero = F.lit(0).cast("long")
    rows = []
    for k in schemas.PRIMARY_KEYS:
        old, new = count((k.table, k.column), "old"), count((k.table, k.column), "new")
        surplus = lambda n: F.greatest(n - 1, F.lit(0))
        rows.append((k.name, new, F.when(null, new).otherwise(0), F.when(~null, surplus(old + new) - surplus(old)).otherwise(0), zero, zero))
    for k in schemas.FOREIGN_KEYS:
        child, parent = (k.table, k.column), (k.parent, k.parent_column)
        lost = lambda children, parents: F.when((parents > 0) & ~null, 0).otherwise(children)
        after = lost(count(child, "old") + count(child, "new"), count(parent, "old") + count(parent, "new"))
        before = lost(count(child, "old"), count(parent, "old"))
        keys = (after > 0).cast("int") - (before > 0).cast("int")
        rows.append((k.name, zero, zero, zero, after - before, keys))
    names = [c.split()[0] for c in _LOG.split(", ")][1:-1]
    sums = by_key.agg(
        *[F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(f"{row[0]}__{name}") for row in rows for name, value in zip(names, row[1:])]
    )
    listed = [F.struct(F.lit(row[0]).alias("constraint_name"), *[F.col(f"{row[0]}__{name}").alias(name) for name in names]) for row in rows]
    return sums.select(F.inline(F.array(*listed)))


def violations_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """(constraint_name, row_count, null_keys, duplicate_keys, orphan_rows, orphan_keys) over all loads, from the log alone."""
    log = _read(spark, f"{folder}/log", _LOG)
    return log.groupBy("constraint_name").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "null_keys", "duplicate_keys", "orphan_rows", "orphan_keys")]
    )
