"""Money sums, rates, ranks and score tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RRF_K = 60  # fixed value: the reciprocal-rank constant


def dollars(amount: Column) -> Column:
    """Sum of a money column, added up in whole cents: exact, the same in any order, and cheaper than a wide decimal."""
    cents = F.floor(amount * 100 + 0.5)
    return F.sum(cents) / F.lit(100.0)


def share(condition: Column) -> Column:
    """Share of rows for which ``condition`` is true; a null condition counts as false."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def violations(condition: Column) -> Column:
    """Number of rows for which ``condition`` is true; 0 over no rows."""
    return F.count(F.when(condition, F.lit(1)))


def reciprocal(rank: Column) -> Column:
    """1 / (60 + rank), 0 for a row the list does not hold."""
    return F.coalesce(1.0 / (RRF_K + rank), F.lit(0.0))


def tier(score: Column) -> Column:
    return F.when(score >= 0.66, "high").when(score >= 0.33, "med").otherwise("low")
