"""Grouped and whole-table aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import global_row_number
from millrace.operators.transforms import explode_words
from millrace.session import materialise


def word_count(df: DataFrame, text: str, separator: str = " ") -> DataFrame:
    """Occurrences of each non-empty token.  Counts are combined before the shuffle."""
    tokens = explode_words(df, text, separator=separator)
    return tokens.groupBy("word").agg(F.count("*").alias("n"))


def aggregate_by_key(df: DataFrame, keys: Sequence[str] | str, **aggregates: Column) -> DataFrame:
    """Aggregates per key; every built-in one is merged per partition before the shuffle."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def combine_by_key_avg(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum, number and mean of the values of each key."""
    return aggregate_by_key(
        df,
        key,
        total=F.sum(value),
        n=F.count(value),
        mean=F.avg(value),
    )


def group_values(
    df: DataFrame,
    key: str,
    value: str,
    spread: str,
    distinct: bool = False,
    parts: int = 8,
) -> DataFrame:
    """All values of each key, sorted, in at most ``parts`` rows ``(key, part, values)``.

    A value's part follows from a hash of ``spread``, a row id (with ``distinct`` its least
    one per key and value), for every key alike: a key that holds a large share of the
    table is ``parts`` lists of about equal length.  Parts without values have no row.
    """
    rows = df.select(key, value, spread)
    if distinct:
        rows = rows.groupBy(key, value).agg(F.min(spread).alias(spread))
    digits = F.substring(F.md5(F.col(spread).cast("string")), 1, 8)
    part = (F.conv(digits, 16, 10).cast("long") % parts).cast("int")
    return (
        rows.withColumn("part", F.coalesce(part, F.lit(0)))
        .groupBy(key, "part")
        .agg(F.sort_array(F.collect_list(value)).alias("values"))
    )


def basic_aggregates(df: DataFrame, key: str, measure: str, label: str) -> DataFrame:
    """Mean, sum, maximum, minimum and count of a measure, distinct count of a label."""
    return aggregate_by_key(
        df,
        key,
        mean=F.avg(measure),
        total=F.sum(measure),
        largest=F.max(measure),
        smallest=F.min(measure),
        n=F.count(measure),
        n_distinct=F.countDistinct(label),
    )


def count_distinct(
    df: DataFrame, keys: Sequence[str], value: str, error: float | None = None
) -> DataFrame:
    """Distinct non-null values per group; with ``error`` as a bounded-memory estimate."""
    count = F.countDistinct(value) if error is None else F.approx_count_distinct(value, error)
    return df.groupBy(*keys).agg(count.alias("n_distinct"))


def having_count(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Groups with exactly ``n`` rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") == n)


def distinct_by_double_group(
    df: DataFrame, keys: Sequence[str], value: str, count_null: bool = True
) -> DataFrame:
    """Distinct values per group, with null counted as one value unless switched off.

    Grouping by keys and value first spreads a hot key over its values.
    """
    pairs = df.groupBy(*keys, value).agg(F.lit(1).alias("_one"))
    counted = F.count("*") if count_null else F.count(value)
    return pairs.groupBy(*keys).agg(counted.alias("n_distinct"))


def ratio_of_counts(
    df: DataFrame, keys: Sequence[str], numerator: Column, denominator: Column, digits: int = 2
) -> DataFrame:
    """count(numerator) / count(denominator) per group in one pass; null over zero."""
    return (
        df.groupBy(*keys)
        .agg(
            F.count_if(numerator).alias("numerator"),
            F.count_if(denominator).alias("denominator"),
        )
        .withColumn(
            "rate", F.round(F.try_divide(F.col("numerator"), F.col("denominator")), digits)
        )
    )


def column_summary(df: DataFrame, vector: str) -> DataFrame:
    """Per position of an array column: count, mean, variance, extremes, non-zeros, norms.

    One fixed-size buffer per task, merged over a tree; one output row per position.
    """
    names = ("mean", "variance", "numNonZeros", "max", "min", "normL1", "normL2")
    summary = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("v")).agg(
        Summarizer.metrics("count", *names).summary(F.col("v")).alias("s")
    )
    arrays = summary.select(
        F.col("s.count").alias("n"),
        *[vector_to_array(F.col(f"s.{n}")).alias(n) for n in names],
    )
    return arrays.select("n", F.posexplode(F.arrays_zip(*names)).alias("pos", "z")).select(
        "pos",
        "n",
        F.col("z.mean").alias("mean"),
        F.col("z.variance").alias("variance"),
        F.col("z.numNonZeros").cast("long").alias("non_zeros"),
        F.col("z.max").alias("largest"),
        F.col("z.min").alias("smallest"),
        F.col("z.normL1").alias("norm_l1"),
        F.col("z.normL2").alias("norm_l2"),
    )


def distinct_index(df: DataFrame, column: str, into: str = "idx") -> DataFrame:
    """Distinct values with a 0-based index in value order."""
    values = df.select(column).distinct()
    return global_row_number(values, column, into).withColumn(into, F.col(into) - 1)


def count_rows(df: DataFrame) -> DataFrame:
    """The number of rows, as one row."""
    return df.agg(F.count("*").alias("n"))
