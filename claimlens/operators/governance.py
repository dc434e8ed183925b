"""Key checks, the listing of keys, comments and tags, and the masked members view."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions.masks import MASKED_LIKE, MASKS
from claimlens.functions.scores import violations
from claimlens.operators.joins import orphans


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, null keys and surplus rows (rows beyond the first of a key) per declared primary key."""

    def one(key: schemas.PrimaryKey) -> DataFrame:
        counted = tables[key.table].groupBy(F.col(key.column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        is_null = F.col("_key").isNull()
        return counted.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(is_null, F.col("_n"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.when(~is_null, F.col("_n") - 1)), F.lit(0)).alias("duplicate_keys"),
        ).select(
            F.lit(key.name).alias("constraint_name"),
            F.lit(key.table).alias("table_name"),
            F.lit(key.column).alias("column_name"),
            "row_count",
            "null_keys",
            "duplicate_keys",
        )

    return _all([one(key) for key in schemas.PRIMARY_KEYS if key.table in tables])


def check_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphan rows and orphan key values per declared foreign key."""

    def one(key: schemas.ForeignKey) -> DataFrame:
        lost = orphans(tables[key.table], key.column, tables[key.parent], key.parent_column)
        return lost.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys")
        ).select(
            F.lit(key.name).alias("constraint_name"),
            F.lit(key.table).alias("table_name"),
            F.lit(key.column).alias("column_name"),
            F.lit(key.parent).alias("parent_table"),
            "orphan_rows",
            "orphan_keys",
        )

    return _all([one(key) for key in schemas.FOREIGN_KEYS if key.table in tables and key.parent in tables])


def constraint_listing(spark: SparkSession) -> DataFrame:
    """(table_name, constraint_type, constraint_name) of the ten declared keys."""
    rows = [(k.table, "PRIMARY KEY", k.name) for k in schemas.PRIMARY_KEYS]
    rows += [(k.table, "FOREIGN KEY", k.name) for k in schemas.FOREIGN_KEYS]
    listed = spark.createDataFrame(rows, "table_name string, constraint_type string, constraint_name string")
    return listed.orderBy("table_name", "constraint_type", "constraint_name")


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The declared keys with the number of rows that break each: null or surplus keys, or orphans."""
    primary = check_primary_keys(tables).select(
        "table_name",
        F.lit("PRIMARY KEY").alias("constraint_type"),
        "constraint_name",
        (F.col("null_keys") + F.col("duplicate_keys")).alias("violations"),
    )
    foreign = check_foreign_keys(tables).select(
        "table_name",
        F.lit("FOREIGN KEY").alias("constraint_type"),
        "constraint_name",
        F.col("orphan_rows").alias("violations"),
    )
    return primary.union(foreign)


# ---- comments and tags ------------------------------------------------------------------------


def describe(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the declared comments and tags in its column metadata."""
    if name not in schemas.TABLES:
        return df
    meta = {f.name: f.metadata for f in schemas.described(name).fields if f.metadata}
    return df.select([F.col(c).alias(c, metadata=meta[c]) if c in meta else F.col(f"`{c}`") for c in df.columns])


def column_listing(spark: SparkSession) -> DataFrame:
    """(table_name, column_name, data_type, comment, synonyms, data_class, pii) of every column."""
    words: dict[str, list[str]] = {}
    for word, columns in schemas.SYNONYMS.items():
        for column in columns:
            words.setdefault(column, []).append(word)
    rows = []
    for name in schemas.TABLES:
        for f in schemas.described(name).fields:
            meta = f.metadata
            rows.append(
                (
                    name,
                    f.name,
                    f.dataType.simpleString(),
                    meta.get("comment"),
                    ", ".join(words.get(f.name, [])) or None,
                    meta.get("data_class"),
                    meta.get("pii"),
                )
            )
    columns = "table_name string, column_name string, data_type string, comment string, synonyms string"
    return spark.createDataFrame(rows, f"{columns}, data_class string, pii string")


def table_listing(spark: SparkSession) -> DataFrame:
    """(table_name, comment, tag, value), one row per table tag."""
    rows = [(t, schemas.TABLE_COMMENTS.get(t), tag, v) for t, tags in schemas.TABLE_TAGS.items() for tag, v in tags.items()]
    return spark.createDataFrame(rows, "table_name string, comment string, tag string, value string")


def column_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, comment, synonyms, data_class, pii, row_count, null_count) of every column of ``tables``.

    Comments and tags are read from the columns' own metadata, so a table that lost them shows none; a table without
    rows counts 0. One aggregate a table, and one row of counts from each task.
    """
    words: dict[str, list[str]] = {}
    for word, columns in schemas.SYNONYMS.items():
        for column in columns:
            words.setdefault(column, []).append(word)
    parts = []
    for name, df in tables.items():
        counted = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            *[violations(F.col(f"`{f.name}`").isNull()).alias(f"_{k}") for k, f in enumerate(df.schema.fields)],
        )
        told = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.metadata.get("comment")).cast("string").alias("comment"),
                F.lit(", ".join(sorted(words.get(f.name, []))) or None).cast("string").alias("synonyms"),
                F.lit(f.metadata.get("data_class")).cast("string").alias("data_class"),
                F.lit(f.metadata.get("pii")).cast("string").alias("pii"),
                "row_count",
                F.col(f"_{k}").alias("null_count"),
            )
            for k, f in enumerate(df.schema.fields)
        ]
        parts.append(counted.select(F.lit(name).alias("table_name"), F.explode(F.array(*told)).alias("c")).select("table_name", "c.*"))
    return _all(parts)


def tagged_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, comment, tag, value, row_count) of every tag of those of ``tables`` that have one."""
    parts = []
    for name, tags in schemas.TABLE_TAGS.items():
        if name in tables:
            told = [F.struct(F.lit(tag).alias("tag"), F.lit(value).alias("value")) for tag, value in tags.items()]
            counted = tables[name].agg(F.count(F.lit(1)).alias("row_count")).select("row_count", F.explode(F.array(*told)).alias("t"))
            about = F.lit(schemas.TABLE_COMMENTS.get(name)).cast("string").alias("comment")
            parts.append(counted.select(F.lit(name).alias("table_name"), about, "t.tag", "t.value", "row_count"))
    return _all(parts)


# ---- personal columns -------------------------------------------------------------------------


def members_for(members: DataFrame, groups: Collection[str] = ()) -> DataFrame:
    """The members as a reader of these groups sees them: clear to PHI readers, masked to all others.

    This is a projection. It protects only what is read through it, not the files underneath.
    """
    if schemas.PHI_READERS in set(groups):
        return members
    return members.select([MASKS[c](c).alias(c) if c in MASKS else F.col(c) for c in members.columns])


def mask_report(members: DataFrame) -> DataFrame:
    """Per tagged column: rows, and rows whose value does not look masked."""
    personal = [c for (table, c) in schemas.COLUMN_TAGS if table == "members"]
    counted = members.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[violations(~F.col(c).like(MASKED_LIKE[c])).alias(c) for c in personal],
    )
    tags = {c: schemas.COLUMN_TAGS[("members", c)]["data_class"] for c in personal}
    return counted.select(
        "row_count",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"), F.lit(tags[c]).alias("data_class"), F.col(c).alias("unmasked")
                    )
                    for c in personal
                ]
            )
        ).alias("c"),
    ).select("c.column_name", "c.data_class", "row_count", "c.unmasked")
