"""Database tables through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Where a database is; credentials come from the caller, never from code."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)


def scan_jdbc(
    spark: SparkSession,
    database: Database,
    table: str,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a database table.

    With a split column, the range ``lower`` to ``upper`` is read by ``partitions``
    tasks side by side; rows outside the range still arrive, in the first and last
    task.  Without one a single task reads the table, so large tables need it.
    """
    properties = {**database.properties, "fetchsize": str(fetch_size)}
    if split_column is None:
        return spark.read.jdbc(database.url, table, properties=properties)
    return spark.read.jdbc(
        database.url,
        table,
        column=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


def sink_jdbc(
    df: DataFrame,
    database: Database,
    table: str,
    mode: str = "append",
    batch_size: int = 5_000,
    connections: int = 16,
) -> None:
    """Write rows with prepared batched inserts, at most ``connections`` at a time.

    ``overwrite`` empties the table and keeps its definition and grants.
    """
    writer = df.write.option("numPartitions", connections)
    if mode == "overwrite":
        writer = writer.option("truncate", True)
    writer.jdbc(
        database.url,
        table,
        mode=mode,
        properties={**database.properties, "batchsize": str(batch_size)},
    )
