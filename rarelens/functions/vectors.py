"""Array-column arithmetic on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_sum(a: Column | str) -> Column:
    return F.aggregate(_col(a), F.lit(0.0), lambda acc, x: acc + x)


def array_mean(a: Column | str) -> Column:
    return array_sum(a) / F.size(_col(a))


def array_std(a: Column | str) -> Column:
    """Population deviation of the elements."""
    values, mean = _col(a), array_mean(a)
    spread = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.sqrt(spread / F.size(values))


def multiply(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return array_sum(multiply(a, b))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    diff = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(diff, F.lit(0.0), lambda acc, d: acc + d * d)


def euclidean(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(squared_distance(a, b))
