"""In-memory rows and catalogue tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import scan_delimited


def frame_from_rows(
    spark: SparkSession, rows: Iterable[Sequence | Mapping], names: Sequence[str] | str
) -> DataFrame:
    """A table from a handful of in-line rows, such as a code list."""
    return spark.createDataFrame(list(rows), names)


def frame_with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind untyped columns, by position, to names and types decided at run time."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns do not fit {len(schema.fields)} fields")
    return df.toDF(*schema.fieldNames()).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def table_create_load(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType | str,
    sep: str,
    overwrite: bool = True,
    location: str | None = None,
) -> DataFrame:
    """Create a table and load a delimited file into it; append when not overwriting."""
    return table_save_read(
        scan_delimited(spark, path, schema, sep),
        table,
        mode="overwrite" if overwrite else "append",
        location=location,
    )


def table_save_read(
    df: DataFrame, table: str, mode: str = "overwrite", location: str | None = None
) -> DataFrame:
    """Save a result as a table and read it back by name."""
    writer = df.write.mode(mode)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
