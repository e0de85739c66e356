"""Scalar and vector column expressions.

A vector is a Python list of Columns (unrolled, stays in whole-stage codegen)
or a single ``array<double>`` Column; the other operand may be numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this many terms an unrolled sum is replaced by array functions.
UNROLL_LIMIT = 100


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def _array(v) -> Column:
    return v if isinstance(v, Column) else F.array(*[_lit(x) for x in v])


def _fold(a, b, term) -> Column:
    """Sum of ``term(a_i, b_i)``, unrolled when both sides are short lists."""
    if not isinstance(a, Column) and not isinstance(b, Column) and len(a) <= UNROLL_LIMIT:
        return reduce(add, [term(_lit(x), _lit(y)) for x, y in zip(a, b, strict=True)])
    pairs = F.zip_with(_array(a), _array(b), term)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _fold(a, b, lambda x, y: x * y)


def linear(x, weights: Sequence[float], intercept: float = 0.0) -> Column:
    """``x . weights + intercept`` with the weights as literals."""
    return dot(x, list(weights)) + F.lit(float(intercept))


def squared_distance(a, b) -> Column:
    return _fold(a, b, lambda x, y: (x - y) * (x - y))


def euclidean(a, b) -> Column:
    return F.sqrt(squared_distance(a, b))


def manhattan(a, b) -> Column:
    return _fold(a, b, lambda x, y: F.abs(x - y))


def nearest(x, centers: Sequence[Sequence[float]]) -> Column:
    """Struct ``(dist, k)`` of the closest centre; ties go to the lowest index.

    The struct comparison orders by distance first and index second, and a NaN
    distance never beats a number, so an all-NaN row gets index 0.
    """
    options = [
        F.struct(euclidean(x, list(c)).alias("dist"), F.lit(k).alias("k"))
        for k, c in enumerate(centers)
    ]
    return F.array_min(F.array(*options)) if len(options) > 1 else options[0]


def sigmoid(z: Column) -> Column:
    return (
        F.when(F.isnan(z), F.lit(float("nan")))
        .when(z > 500.0, F.lit(1.0))
        .when(z < -500.0, F.lit(0.0))
        .otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    )


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(float(high))), F.lit(float(low)))


def soft_threshold(z: Column, gamma) -> Column:
    g = _lit(gamma)
    return F.signum(z) * F.greatest(F.abs(z) - g, F.lit(0.0))


def round_half_away(x: Column) -> Column:
    """Round to the nearest integer, halves away from zero."""
    return F.round(x)


def safe_divide(num: Column, den: Column) -> Column:
    """IEEE division: x/0 gives a signed infinity and 0/0 gives NaN."""
    zero = (
        F.when(F.isnan(num) | (num == 0.0), F.lit(float("nan")))
        .when(num > 0.0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    return F.when(den != 0.0, num / den).otherwise(zero)
