"""Vectors of fractions as vectors of whole numbers, for sums that are exact in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Neither NULL nor with a component that is NULL or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def whole_vectors(vectors: DataFrame, column: str, scale: int, most: int) -> DataFrame:
    """The finite vectors, each component ``c`` as the whole number floor(scale * c): columns vec_id, x.

    A number beyond ``most`` in size becomes ``most`` with its sign, so that sums of what is computed
    from it have a bound. All other columns are left out, whatever their names.
    """
    rows = vectors.select(vectors["vec_id"], vectors[column].cast("array<double>").alias("x"))
    # Limits come before the rounding: a huge fraction has no whole number of 64 bits.
    whole = F.transform("x", lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-float(most))), F.lit(float(most)))))
    return rows.where(finite(F.col("x"))).select("vec_id", whole.cast("array<bigint>").alias("x"))
