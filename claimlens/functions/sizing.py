"""The bound for broadcasts, and columns worked out once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def evaluated_once(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a costly column behind a one-element explode.

    Filters and projections on the column would otherwise be merged into its expression and work it
    out again for each mention.
    """
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.array(F.col(column))).alias(column))
