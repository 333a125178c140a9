"""Set operations and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows of both tables with ``_left`` and ``_right``: who has them.

    One aggregate instead of a join after two distincts: repeats are folded within each
    task, every distinct row is shuffled once, and nulls count as equal.
    """
    names = left.columns
    tagged = left.withColumns({"_left": F.lit(True), "_right": F.lit(False)}).union(
        right.toDF(*names).withColumns({"_left": F.lit(False), "_right": F.lit(True)})
    )
    return tagged.groupBy(*names).agg(
        F.max("_left").alias("_left"), F.max("_right").alias("_right")
    )


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left table that the right one does not have."""
    return _sides(left, right).filter(~F.col("_right")).drop("_left", "_right")


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows both tables have."""
    return _sides(left, right).filter("_left AND _right").drop("_left", "_right")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows without repeats."""
    return df.distinct()


def drop_duplicates_by(
    df: DataFrame, keys: Sequence[str], keep_first_by: Sequence[Column | str]
) -> DataFrame:
    """One row per key: the first in the given order, so that reruns agree.

    All but one row per key and task are dropped before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keep_first_by))
    return df.withColumn("_place", place).filter(F.col("_place") <= 1).drop("_place")


def union_rows(*tables: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Stack tables by column name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), tables
    )
