"""Ordering, limits and top-n.

Every order carries a tie-break so that results do not depend on task timing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark drops rows beyond the n-th of a group before the shuffle up to this n
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
PRUNED_BEFORE_SHUFFLE = 1000


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str] | str,
    order: Sequence[Column],
    n: int,
    into: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered.

    Written as a filter on ``row_number`` so that each task keeps only ``n`` rows per
    group before the shuffle.  For an ``n`` too large for that rule the groups are
    first cut down within ``salts`` parts each.
    """
    keys = [group] if isinstance(group, str) else list(group)
    if n > PRUNED_BEFORE_SHUFFLE:
        # By partition, not by content: equal rows are spread too.
        part = F.pmod(F.spark_partition_id(), F.lit(salts))
        inner = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn("_place", F.row_number().over(inner))
            .filter(F.col("_place") <= n)
            .drop("_part", "_place")
        )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(into, place).filter(F.col(into) <= n)


def group_topn_array(
    df: DataFrame, group: str, value: str, n: int, into: str = "top"
) -> DataFrame:
    """The ``n`` largest values of each group, duplicates kept, largest first, as a list."""
    top = top_n_per_group(df.select(group, value), group, [F.desc(value)], n)
    return top.groupBy(group).agg(
        F.sort_array(F.collect_list(value), asc=False).alias(into)
    )


def global_topn(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in an order; each task keeps ``n``, the rest is never shuffled."""
    return df.orderBy(*order).limit(n)


def topn_of_key(
    df: DataFrame, key: str, value, order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of one key."""
    return global_topn(df.filter(F.col(key) == F.lit(value)), order, n)


def argmax_row(df: DataFrame, measure: str, *tie_break: str) -> DataFrame:
    """The row with the largest measure."""
    return global_topn(df, [F.desc(measure), *tie_break], 1)


def sort_rows(df: DataFrame, *order: Column | str) -> DataFrame:
    """A total order by range partitioning; end with a unique column to split hot values."""
    return df.orderBy(*order)


def secondary_sort(df: DataFrame, first: str, second: str, *tie_break: str) -> DataFrame:
    """Order by two keys: rows are range-partitioned by both, then sorted in place."""
    order = [first, second, *tie_break]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
