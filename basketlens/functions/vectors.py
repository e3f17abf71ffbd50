"""Arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null if a vector is null, 0.0 if one has no length."""
    return F.when(
        a.isNotNull() & b.isNotNull(),
        F.coalesce(
            F.try_divide(dot(a, b), norm(a) * norm(b)),
            F.lit(0.0),
        ),
    )
