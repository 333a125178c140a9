"""Whole-table row numbers and running totals that no single task has to hold.

A window without a partition key runs in one task.  Here the table is sorted into ranges,
written once with each row's place in its range, and a small table of per-range totals
supplies the offset.  Where the ranges are cut only decides how work is shared out: the
result is exact for any cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialise

# ``monotonically_increasing_id`` holds the number of the partition above these bits and counts rows below.
PLACE_BITS = 33


def sorted_ranges(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The table in ascending order, nulls first, written once, with ``_range`` and ``_place`` in it.

    Rows of a smaller ``_range`` come first; ``_place`` counts from 0 without gaps.  Rows with equal
    values of ``order`` are ordered, and dealt to ranges, by a hash of the whole row, so a value
    that very many rows share takes up several ranges; only rows equal in every column
    stay together.  ``ranges``: how many at most, None for the session's shuffle partitions.
    """
    ties = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    keys = [*(F.col(f"`{c}`").asc_nulls_first() for c in order), F.col("_tie")]
    tied = df.withColumn("_tie", ties)
    dealt = tied.repartitionByRange(*([ranges] if ranges else []), *keys)
    numbered = dealt.sortWithinPartitions(*keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    written = numbered.withColumn("_range", F.shiftright("_at", PLACE_BITS)).withColumn("_place", F.col("_at").bitwiseAND(2**PLACE_BITS - 1))
    return materialise(written.drop("_at"), "ranges")


def _offsets(per_range: DataFrame, totals: Sequence[str]) -> DataFrame:
    """Per range, the sum of each total over all earlier ranges.

    One row per range, and no more ranges than shuffle partitions: one task, and safe to ship.
    """
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        per_range.select("_range", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in totals))
    )


def global_row_number(
    df: DataFrame,
    order: str,
    into: str = "row_no",
    tie_break: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Number all rows from 1 in ascending order of a column, nulls first.

    Equal values are ordered by ``tie_break``, then by a hash of the row.
    """
    cut = sorted_ranges(df, [order, *tie_break], ranges)
    before = _offsets(cut.groupBy("_range").agg(F.count("*").alias("_before")), ["_before"])
    return cut.join(before, "_range").select(
        *(F.col(f"`{c}`") for c in df.columns if c != into), (F.col("_before") + F.col("_place") + 1).alias(into)
    )


def global_running_sum(
    df: DataFrame, order: str, sums: dict[str, str], ranges: int | None = None
) -> DataFrame:
    """Running sums over the whole table, for an order column without repeats.

    ``sums`` maps an input column to the output column that receives its total up
    to and including the row.  Group equal order values first: that also folds a
    value shared by many rows into one.
    """
    totals: dict[str, Column] = {f"_before_{n}": F.sum(n) for n in sums}
    cut = sorted_ranges(df, [order], ranges)
    before = _offsets(cut.groupBy("_range").agg(*(c.alias(n) for n, c in totals.items())), list(totals))
    upto = Window.partitionBy("_range").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return cut.join(before, "_range").withColumns(
        {out: F.col(f"_before_{n}") + F.sum(n).over(upto) for n, out in sums.items()}
    ).drop("_range", "_place", *totals)


def rank_within(
    df: DataFrame, group: str, order: Sequence[str], into: str = "rank", ranges: int | None = None
) -> DataFrame:
    """Number the rows of each group from 1 in ascending order, however many a group has.

    All rows are sorted by group and order into ranges, so a group with a third of them takes up
    several; its rank is the place in the range less where the group starts there, plus
    its rows in earlier ranges.  Rows equal in ``order`` follow a hash of the row.
    """
    cut = sorted_ranges(df, [group, *order], ranges)
    # One row per group and range that holds it: a group has no more of them than there are ranges.
    parts = cut.groupBy(group, "_range").agg(F.count("*").alias("_n"), F.min("_place").alias("_start"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col(group).alias("_group"), F.col("_range").alias("_part"), (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_start")).alias("_shift")
    )
    same = cut[group].eqNullSafe(before["_group"]) & (cut["_range"] == before["_part"])
    return cut.join(before, same).select(
        *(cut[f"`{c}`"] for c in df.columns if c != into), (F.col("_place") + F.col("_shift") + 1).cast("int").alias(into)
    )
