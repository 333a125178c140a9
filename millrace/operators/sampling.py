"""Samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import global_row_number
from millrace.operators.topn import top_n_per_group

HASH_RANGE = 2**32


def hash_share(ids: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) that depends only on the row's id and the seed.

    Taken from the first 32 bits of the MD5 of ``id|...|seed``.
    """
    text = F.concat_ws("|", *[F.col(i).cast("string") for i in ids], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / HASH_RANGE


def sample_fraction(df: DataFrame, ids: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """Each row with the given probability, without replacement.

    Unlike ``DataFrame.sample`` the choice depends on a row's id and the seed alone, not
    on the layout of the data.
    """
    return df.filter(hash_share(ids, seed) < fraction)


def random_split(
    df: DataFrame, ids: Sequence[str], weights: Sequence[float], seed: int, into: str = "part"
) -> DataFrame:
    """Number the rows of a random split by normalised weights, in a new column.

    Unlike ``DataFrame.randomSplit`` the part of a row does not depend on the
    layout of the data, so a recomputed task puts it in the same part, and all
    parts come from one pass: filter on the column.
    """
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total = float(sum(weights))
    share = hash_share(ids, seed)
    part = F.lit(len(weights) - 1)
    edge = total
    for i in range(len(weights) - 1, 0, -1):
        edge -= weights[i]
        part = F.when(share < edge / total, i - 1).otherwise(part)
    return df.withColumn(into, part)


def kfold_blocks(df: DataFrame, position: str, k: int, into: str = "fold") -> DataFrame:
    """``k`` consecutive blocks of equal size by row position; the first ones take the rest."""
    numbered = global_row_number(df, position, "_row")
    n = numbered.agg(F.count("*")).scalar()
    small = F.floor(F.col("_n") / k)
    larger = F.col("_n") - small * k  # blocks that hold one row more
    head = larger * (small + 1)
    row = F.col("_row") - 1
    fold = F.when(row < head, F.floor(row / (small + 1))).otherwise(
        larger + F.floor(F.try_divide(row - head, small))
    )
    return (
        numbered.withColumn("_n", n)
        .withColumn(into, (fold + 1).cast("int"))
        .drop("_n", "_row")
    )


def holdout_nth_per_user(
    df: DataFrame,
    user: str,
    position: str,
    start: int,
    stop: int,
    max_test: int | None = None,
    into: str = "is_test",
) -> DataFrame:
    """Mark the ``start``-th to ``stop``-th row of each user as test rows.

    ``position`` gives each row its unique place in the input.  With ``max_test``
    only the first so many test rows by position stay test rows.  At most ``stop``
    rows per user and task are shuffled to find them, so a user with very many rows
    is no burden.
    """
    first_rows = top_n_per_group(
        df.select(user, position), user, [F.asc(position)], stop, "_place"
    )
    test = first_rows.filter(F.col("_place") >= start).select(position)
    if max_test is not None and max_test > 0:
        test = test.orderBy(position).limit(max_test)
    marked = test.withColumn(into, F.lit(True))
    return df.join(marked, position, "left").withColumn(
        into, F.coalesce(F.col(into), F.lit(False))
    )
