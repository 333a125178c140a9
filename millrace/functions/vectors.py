"""Dense vectors as ``array<double>`` columns.

All functions are row-local expressions over built-in higher-order functions, so
they run inside the scan stage without a shuffle and, but for one, without Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = 0.0


def dense(vector: Column) -> Column:
    """Any numeric array as doubles."""
    return vector.cast("array<double>")


def elementwise(a: Column, b: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Apply an operator to the elements at the same place of two vectors."""
    return F.zip_with(a, b, op)


def add(a: Column, b: Column) -> Column:
    return elementwise(a, b, lambda x, y: x + y)


def multiply(a: Column, b: Column) -> Column:
    return elementwise(a, b, lambda x, y: x * y)


def divide(a: Column, b: Column) -> Column:
    """Element quotients; null where the divisor is zero."""
    return elementwise(a, b, F.try_divide)


def less(a: Column, b: Column) -> Column:
    return elementwise(a, b, lambda x, y: x < y)


def equal(a: Column, b: Column) -> Column:
    return elementwise(a, b, lambda x, y: x == y)


def add_scalar(a: Column, x: float) -> Column:
    return F.transform(a, lambda v: v + x)


def scale(a: Column, x: float) -> Column:
    return F.transform(a, lambda v: v * x)


def total(a: Column) -> Column:
    """Sum of the elements, added in order."""
    return F.aggregate(a, F.lit(ZERO), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(multiply(a, b))


def norm(a: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of the angle; null when a vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def squared_distance(a: Column, b: Column) -> Column:
    return total(elementwise(a, b, lambda x, y: (x - y) * (x - y)))


def running_sum(a: Column) -> Column:
    """Sums of all prefixes.

    The one function here that runs in Python: a higher-order function would copy the
    growing result once per element (seven times slower at 64 elements).
    """

    @F.pandas_udf("array<double>")
    def prefix(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if v is None else np.cumsum(v) for v in batch])

    return prefix(a)


def largest(a: Column) -> Column:
    return F.array_max(a)


def argmax(a: Column) -> Column:
    """0-based place of the first largest element."""
    return F.array_position(a, F.array_max(a)) - 1


def both(a: Column, b: Column) -> Column:
    """Element-wise AND of two boolean vectors."""
    return elementwise(a, b, lambda x, y: x & y)


def either(a: Column, b: Column) -> Column:
    """Element-wise OR of two boolean vectors."""
    return elementwise(a, b, lambda x, y: x | y)


def negate(a: Column) -> Column:
    """Element-wise NOT of a boolean vector."""
    return F.transform(a, lambda x: ~x)


def any_nonzero(a: Column) -> Column:
    return F.exists(a, lambda x: x != ZERO)


def all_nonzero(a: Column) -> Column:
    return F.forall(a, lambda x: x != ZERO)


def rounded(a: Column) -> Column:
    """Half away from zero."""
    return F.transform(a, lambda x: F.round(x))


def ceiling(a: Column) -> Column:
    return F.transform(a, lambda x: F.ceil(x).cast("double"))


def floored(a: Column) -> Column:
    return F.transform(a, lambda x: F.floor(x).cast("double"))


def sign(a: Column) -> Column:
    return F.transform(a, lambda x: F.signum(x))


def absolute(a: Column) -> Column:
    return F.transform(a, lambda x: F.abs(x))


def element(a: Column, i: int) -> Column:
    """0-based element; negative places count from the end; null outside."""
    return F.get(a, F.lit(i)) if i >= 0 else F.try_element_at(a, F.lit(i))


def span(a: Column, first: int, last: int) -> Column:
    """Elements from ``first`` to ``last``, both 0-based and included.

    A negative ``last`` counts from the end; a ``last`` before ``first`` walks back.
    """
    if last < 0:
        return F.slice(a, F.lit(first + 1), F.size(a) + F.lit(last - first + 1))
    if last < first:
        return F.reverse(F.slice(a, last + 1, first - last + 1))
    return F.slice(a, first + 1, last - first + 1)


def assign(a: Column, first: int, last: int, value: float | Column) -> Column:
    """The vector with places ``first`` to ``last`` set to a number or to a vector's elements."""
    if isinstance(value, Column):
        return F.transform(
            a, lambda x, i: F.when(i.between(first, last), F.get(value, i - first)).otherwise(x)
        )
    return F.transform(
        a, lambda x, i: F.when(i.between(first, last), F.lit(float(value))).otherwise(x)
    )


def joined(a: Column, b: Column) -> Column:
    """One vector after the other."""
    return F.concat(a, b)
