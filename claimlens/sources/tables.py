"""Reading and writing the named tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions.sizing import evaluated_once


def table_path(directory: str, name: str) -> str:
    return f"{directory.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A Parquet table; the claims tables are read with their declared schema."""
    reader = spark.read
    if name in schemas.TABLES:
        reader = reader.schema(schemas.TABLES[name])
    return reader.parquet(table_path(directory, name))


def load_records(spark: SparkSession, path: str, name: str, file_format: str = "json") -> DataFrame:
    """Raw records (JSON lines, CSV, ...) read straight into the table's types and column order."""
    return spark.read.schema(schemas.TABLES[name]).format(file_format).load(path)


_BROKEN = "_broken"


def load_with_refusals(spark: SparkSession, path: str, name: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw records, a JSON object a line, as (rows of the table, refusals (record, reason)); every line is in one of the two.

    A line is refused as ``no record`` when it is not one JSON object, as ``no <key>`` when it lacks the table's key, and as
    ``not of type: a, b`` when fields of it do not fit their columns. A missing or null field is a null, and fields the
    table does not have are passed over. Blank lines are nothing. Nothing is turned into a null unseen.
    """
    fields = schemas.TABLES[name].fields
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{_BROKEN} string"])
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", "record")
    read = evaluated_once(lines.withColumn("_r", F.from_json("record", schema, {"columnNameOfCorruptRecord": _BROKEN})), "_r")
    told = evaluated_once(read.withColumn("_v", F.try_parse_json("record")), "_v")
    given = lambda f: F.try_variant_get("_v", f"$.{f.name}", "variant")
    unfit = [F.when(F.col("_r")[f.name].isNull() & given(f).isNotNull() & ~F.is_variant_null(given(f)), F.lit(f.name)) for f in fields]
    names = F.array_join(F.array_compact(F.array(*unfit)), ", ")
    no_object = F.try_variant_get("_v", "$", "map<string,variant>").isNull()
    reason = F.when(no_object, "no record").when(names != "", F.concat(F.lit("not of type: "), names))
    reason = reason.when(F.col("_r")[_BROKEN].isNotNull(), "no record")
    if key:
        reason = reason.when(F.col("_r")[key].isNull(), f"no {key}")
    judged = evaluated_once(told.withColumn("reason", reason), "reason")
    good = judged.where("reason is null").select([F.col("_r")[f.name].alias(f.name) for f in fields])
    return good, judged.where("reason is not null").select("record", "reason")


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's columns in declared order and type; a value that does not fit becomes null."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.TABLES[name].fields])


def laid_out(df: DataFrame, cluster_by: Sequence[str]) -> DataFrame:
    """The rows in sorted ranges of the columns. Wide columns that follow from others of a row are better made after this."""
    return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)


def write(
    df: DataFrame, path: str, skip_empty: bool = True, cluster_by: Sequence[str] = (), find_by: Sequence[str] = ()
) -> bool:
    """Replace the table at ``path``, schema included. An empty input is skipped and False returned. Pages are packed by zstd: details
    and notes repeat themselves.

    ``cluster_by`` lays the rows out in ranges of those columns, so that a lookup on the first of them
    skips the other files and row groups by their statistics. End it with the key: the ranges can then
    cut through a value that many rows share.

    ``find_by`` names further columns that rows are looked up by (``find``). Each row group gets a Bloom filter of their
    values, of a size that fits what is in it and is at most 1 MB, so that a lookup skips groups whose statistics do not help,
    as the values lie all over the table.

    Asking whether it is empty runs ``df`` up to its first row, which for a shuffled frame is most of
    the work; a caller who knows it is not says so. ``df`` must not read from ``path``.
    """
    if skip_empty and df.isEmpty():
        return False
    if cluster_by:
        df = laid_out(df, cluster_by)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if find_by:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    return True


def find(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """The rows of a stored table whose ``column`` is one of ``values``; nulls are never found.

    Asked in lists of ten, which is what the Parquet reader takes down to row groups as values (a longer list goes down as
    its range, which skips nothing where keys are spread). For thousands of values join instead.
    """
    asked = sorted({v for v in values if v is not None})
    lists = [F.col(column).isin(asked[i : i + 10]) for i in range(0, len(asked), 10)]
    return df.where(reduce(Column.__or__, lists, F.lit(False)))


class KeyViolation(ValueError):
    """A table's key column holds nulls or repeats."""


def write_keyed(
    df: DataFrame, path: str, key: str, skip_empty: bool = True, cluster_by: Sequence[str] = (), find_by: Sequence[str] = ()
) -> bool:
    """``write`` for a table with a key: refused, and nothing replaced, when a key is null or occurs twice.

    The counts per key are aggregated before their shuffle; ``df`` is read twice, so hand in something stored.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = counts.where(F.col(key).isNull() | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise KeyViolation(f"{key} = {bad[0][key]!r} occurs {bad[0]['n']} times in {path}")
    return write(df, path, skip_empty, cluster_by, find_by)


def count_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)


class Book(Mapping):
    """Tables by name, each built or read when first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self):
        return len(self._makers)


def stored_book(spark: SparkSession, directory: str, names: list[str] | None = None) -> Book:
    """The claims book as Parquet tables under one directory."""
    return Book({n: (lambda n=n: load(spark, directory, n)) for n in names or schemas.BOOK_TABLES})
