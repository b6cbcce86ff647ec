"""Vectors as exact integers: which rows count, and how components are scaled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components saturate here, so that squared distances of 64 of them fit a 64-bit integer.
MOST = 1 << 27


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as bigint, at least -MOST and at most MOST."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-float(MOST)), F.least(
        F.lit(float(MOST)), x.cast("double") * F.lit(float(scale))))))


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int,
                    *carried: Column) -> DataFrame:
    """(vec_id, q, carried columns) of the rows with a finite vector; ``carried`` have names of their own."""
    vector = vectors[vector_col]
    return vectors.filter(finite(vector)).select(
        vectors[id_col].alias("vec_id"), scaled(vector, scale).alias("q"), *carried)

