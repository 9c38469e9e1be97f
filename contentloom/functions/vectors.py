"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from contentloom.functions.core import col


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(
            col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
        )
    )


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """NULL for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
