"""Vector arithmetic on array columns. A zero vector has no direction: cosine gives null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _total(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclidean(a: Column, b: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_total(F.zip_with(a, b, square)))


def is_finite(a: Column) -> Column:
    """Whether a vector has components and all of them are numbers; false for null."""
    bad = F.exists(a, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(a) > 0) & ~bad, F.lit(False))


def dimension(a: Column) -> Column:
    return F.size(a)


def head(a: Column, n: int) -> Column:
    return F.slice(a, 1, n)
