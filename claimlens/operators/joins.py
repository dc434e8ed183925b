"""Joins along the declared keys, and rows without a parent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import schemas


def declared_key(left: str, right: str) -> schemas.ForeignKey:
    """The foreign key that joins two tables, in either direction; an undeclared pair is refused."""
    for key in schemas.FOREIGN_KEYS:
        if {key.table, key.parent} == {left, right}:
            return key
    raise ValueError(f"no declared key joins {left} and {right}")


def join_declared(
    tables: Mapping[str, DataFrame], left: str | tuple[str, DataFrame], right: str, how: str = "inner"
) -> DataFrame:
    """Join two tables on their declared key. ``left`` may be (name, frame) to go on from an earlier join.

    Columns of the right table that the left already has are prefixed with the right table's name.
    Outer joins that keep the rows of the one side are made of their matched and their unmatched rows: an
    outer join cannot split the many side when one key holds much of it, inner and anti joins can.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"not a declared join: {how}")
    name, frame = (left, tables[left]) if isinstance(left, str) else left
    key = declared_key(name, right)
    other = tables[right]
    if key.table == name:
        mine, theirs = key.column, key.parent_column
    else:
        mine, theirs = key.parent_column, key.column
    clash = {c: f"{right}_{c}" for c in other.columns if c in frame.columns and c != theirs}
    other = other.withColumnsRenamed(clash)
    if mine != theirs:
        other = other.withColumnRenamed(theirs, mine)
    if how == "inner" or how == ("left" if key.table == name else "right"):
        return frame.join(other, mine, how)
    joined = frame.join(other, mine)
    if how != "right":
        joined = joined.unionByName(frame.join(other.select(mine).distinct(), mine, "left_anti"), allowMissingColumns=True)
    if how != "left":
        joined = joined.unionByName(other.join(frame.select(mine).distinct(), mine, "left_anti"), allowMissingColumns=True)
    return joined


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with their row counts; a null key counts as one.

    Both sides are reduced to one row per key before the join, so a key that holds much of a table
    reaches it as one row.
    """
    keys = child.groupBy(F.col(column).alias(parent_column)).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(parent.select(parent_column).distinct(), parent_column, "left_anti")
