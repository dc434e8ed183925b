"""Masks for the personal columns, as column expressions and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# fixed values: the text that replaces the hidden part
_SQL = {
    "mask_ssn": "concat('XXX-XX-', right({0}, 4))",
    "mask_name": "concat(left({0}, 1), '*** ***')",
    "mask_dob": "concat(left({0}, 4), '-XX-XX')",
}


def mask_ssn(ssn: str) -> Column:
    """Keeps the last four characters; null stays null."""
    return F.expr(_SQL["mask_ssn"].format(ssn))


def mask_name(name: str) -> Column:
    """Keeps the first letter."""
    return F.expr(_SQL["mask_name"].format(name))


def mask_dob(dob: str) -> Column:
    """Keeps the year."""
    return F.expr(_SQL["mask_dob"].format(dob))


MASKS = {"member_ssn": mask_ssn, "member_name": mask_name, "member_dob": mask_dob}
# what a masked value looks like, as a LIKE pattern
MASKED_LIKE = {"member_ssn": "XXX-XX-%", "member_name": "%*** ***", "member_dob": "____-XX-XX"}


def register_masks(spark: SparkSession) -> None:
    """mask_ssn, mask_name and mask_dob for spark.sql."""
    for name, body in _SQL.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {body.format('value')}"
        )
