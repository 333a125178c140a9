"""Joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def join_inner(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Equi inner join.

    No hint is given: the optimiser broadcasts a side it knows or finds to be small
    and otherwise sorts and merges, splitting partitions that turn out skewed.
    """
    return left.join(right, on, "inner")


def join_struct(left: DataFrame, right: DataFrame, on: Column, names=("l", "r")) -> DataFrame:
    """Join that returns both records whole, each as a struct.

    ``on`` refers to the sides through ``names``, e.g. ``F.col("l.id") == F.col("r.id")``.
    """
    a, b = names
    joined = left.alias(a).join(right.alias(b), on, "inner")
    return joined.select(F.struct(f"{a}.*").alias(a), F.struct(f"{b}.*").alias(b))


def _thinned(keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The distinct keys, up to 16 copies of each.

    Copies of a key are folded within each task, so a key repeated very often does not
    meet in one task.  Grouping by a salt as well keeps the result from arriving
    partitioned by the key alone: the join then has a shuffle of its own on both sides,
    without which adaptive execution cannot split a skewed left side.
    """
    names = [on] if isinstance(on, str) else list(on)
    salt = F.pmod(F.spark_partition_id(), F.lit(16)).alias("_salt")
    return keys.select(*names, salt).distinct().drop("_salt")


def join_semi(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of the left table whose key occurs in the right one (IN from a query)."""
    return left.join(_thinned(right, on), on, "left_semi").select(*left.columns)


def join_anti_flagged(
    left: DataFrame, flags: DataFrame, on: str, flag: str = "flag"
) -> DataFrame:
    """Rows whose key is not flagged true; unknown keys and null flags stay.

    ``flags`` has one row per key.  Nothing is hinted: a list whose size is known to be
    small (a stored table) is broadcast, also to a stream.
    """
    return left.join(flags.filter(F.col(flag)), on, "left_anti").select(*left.columns)


def join_outer_default(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], defaults: dict
) -> DataFrame:
    """Left outer join with the unmatched side's nulls replaced by defaults."""
    joined = left.join(right, on, "left")
    return joined.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()}
    )


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold more than ``share`` of the rows: fewer than ``1 / share`` of them.

    Counts are combined per task; only the hot keys reach the driver.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = counts.filter(F.col(key).isNotNull() & (F.col("_n") > total * F.lit(share)))
    return sorted(row[0] for row in hot.select(key).collect())


def join_code_table(
    left: DataFrame,
    codes: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
) -> DataFrame:
    """Join a code table.

    No hint is given: the optimiser ships a table whose bytes it knows, or finds at run
    time, to be below its threshold, and otherwise sorts and merges.
    """
    return left.join(codes, on, how)


def zip_by_row_id(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Pair two tables of equal order through the row id each of them carries."""
    return left.join(right, row_id, "inner")
