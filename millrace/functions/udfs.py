"""User-defined functions and aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.folding import fold_batches


def register_sql_function(
    spark: SparkSession, name: str, parameters: str, returns: str, body: str
) -> None:
    """Register a function for SQL text whose body is SQL, so it is inlined into the plan."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}"
    )


def register_strlen(spark: SparkSession, name: str = "strlen") -> None:
    """Length of a string in characters."""
    register_sql_function(spark, name, "s STRING", "INT", "length(s)")


def register_arrow_function(
    spark: SparkSession, name: str, function: Callable[[pd.Series], pd.Series], returns: str
) -> None:
    """Register a vectorised Python function for what SQL cannot express."""
    spark.udf.register(name, F.pandas_udf(function, returns))


def row_count() -> Column:
    """Counts the rows of a group, rows with a null included."""
    return F.count(F.lit(1))


def custom_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    inputs: Sequence[str],
    update: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    buffer_schema: str,
    evaluate: dict[str, Column],
) -> DataFrame:
    """A custom aggregate by update, merge and evaluate steps.

    ``update`` turns the rows of an Arrow batch into one buffer row per key, ``merge``
    folds buffer rows into one per key, both for all keys of a frame at once;
    ``evaluate`` gives the result columns from the final buffer.  Buffers are made and
    merged per task before the shuffle, so a hot key sends about one row per task.
    """
    keys = list(keys)
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{key_schema}, {buffer_schema}"
    buffers = df.select(*keys, *inputs).mapInArrow(fold_batches(update, merge, schema), schema)
    # A task's final buffers are as many as its keys.
    together = buffers.repartition(*keys).mapInArrow(fold_batches(merge, merge, schema, None), schema)
    return together.select(*keys, *[c.alias(n) for n, c in evaluate.items()])
