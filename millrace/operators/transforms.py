"""Projections, filters and row-wise transforms."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    """Keep the named columns; the scan then reads no others."""
    return df.select(*names)


def computed_column(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Add columns given as expressions."""
    return df.withColumns(
        {n: F.expr(c) if isinstance(c, str) else c for n, c in columns.items()}
    )


def filter_expr(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows that meet a condition given as a column or as SQL text."""
    return df.filter(condition)


def filter_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value lies in the closed range."""
    return df.filter(F.col(column).between(low, high))


def filter_null(df: DataFrame, column: str, is_null: bool = True, **equals) -> DataFrame:
    """Rows where a column is null (or is not), and others equal given values."""
    test = F.col(column).isNull() if is_null else F.col(column).isNotNull()
    for name, value in equals.items():
        test = test & (F.col(name) == F.lit(value))
    return df.filter(test)


def filter_conjunction(df: DataFrame, **equals) -> DataFrame:
    """Rows where every named column equals its value.

    The values are bound as parameters, never pasted into SQL text.
    """
    where = " AND ".join(f"`{name}` = :{name}" for name in equals)
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {where}", args=equals, df=df)


def map_format_row(df: DataFrame, template: str, into: str = "line") -> DataFrame:
    """One string per row from a template with ``{column}`` slots.

    Built from ``concat`` so that it stays in generated code; null in, null out.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        text, brace, rest = rest.partition("{")
        if text:
            parts.append(F.lit(text))
        if brace:
            name, _, rest = rest.partition("}")
            parts.append(F.col(name).cast("string"))
    return df.select(F.concat(*parts).alias(into))


def explode_words(
    df: DataFrame, text: str, *keep: str, separator: str = " ", into: str = "word"
) -> DataFrame:
    """One row per non-empty token between separators (a regular expression).

    Empty tokens are dropped after the explode: that keeps the whole step in generated
    code, which a filter inside the array would leave.
    """
    tokens = df.select(*keep, F.explode(F.split(text, separator)).alias(into))
    return tokens.filter(F.col(into) != "")


def flat_map(df: DataFrame, elements: Column, into: str, *keep: str) -> DataFrame:
    """One output row per element of an array expression, with the kept columns."""
    return df.select(*keep, F.explode(elements).alias(into))


def map_partitions(
    df: DataFrame,
    transform: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply a pandas function batch by batch; a partition is never held whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        return (transform(batch) for batch in batches)

    return df.mapInPandas(run, schema)


def map_partitions_with_index(df: DataFrame, into: str = "partition_no") -> DataFrame:
    """Tag each row with the 1-based number of the partition it is in."""
    return df.withColumn(into, F.spark_partition_id() + 1)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind rows to a declared record type; a missing field is an error."""
    missing = [n for n in schema.fieldNames() if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the declared type: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def clean_number(text: Column, missing: str = "?", non_negative: bool = False) -> Column:
    """A number from quoted text: quotes stripped, the missing mark and junk give 0."""
    bare = F.replace(text, F.lit('"'), F.lit(""))
    number = F.when(bare == missing, F.lit(0.0)).otherwise(
        F.coalesce(bare.try_cast("double"), F.lit(0.0))
    )
    return F.greatest(number, F.lit(0.0)) if non_negative else number


def assemble_features(
    df: DataFrame, columns: list[str], label: Column | str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Columns ``label`` (double) and ``features`` (array of doubles)."""
    target = F.col(label) if isinstance(label, str) else label
    return df.select(
        *keep,
        target.cast("double").alias("label"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("features"),
    )


def lookup_key(df: DataFrame, key: str, value) -> DataFrame:
    """All rows of one key; the filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def decode_flags(
    df: DataFrame, flags: str, codes: DataFrame, index: str, name: str, into: str
) -> DataFrame:
    """Replace an array of 0/1 flags by the names of the positions set to 1.

    ``codes`` maps a 0-based position to its name.  It has one row per array
    position, so it is read once as a single-row subquery and the flagged table is
    neither exploded nor shuffled.
    """
    table = codes.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(index).cast("int"), F.col(name))))
    ).scalar()
    positions = F.sequence(F.lit(0), F.size(flags) - 1)
    chosen = F.filter(positions, lambda i: F.get(F.col(flags), i) == 1)
    return df.withColumn("_codes", table).withColumn(
        into, F.transform(chosen, lambda i: F.element_at(F.col("_codes"), i))
    ).drop("_codes")


def relayout(df: DataFrame, spread: int | None = None, merge: int | None = None) -> DataFrame:
    """Change the partition count: ``spread`` with a shuffle, ``merge`` without."""
    if spread is not None:
        df = df.repartition(spread)
    if merge is not None:
        df = df.coalesce(merge)
    return df


def summary_row(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Whole-table reductions (count, sum, first by order, ...) in one pass, as one row."""
    return df.agg(*[c.alias(n) for n, c in aggregates.items()])
