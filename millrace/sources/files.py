"""File readers and writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def scan_delimited(
    spark: SparkSession,
    path: str,
    schema: Schema,
    sep: str,
    null_text: str | None = None,
    header: bool = False,
) -> DataFrame:
    """Typed columns from lines of separated fields.

    The schema is declared, so no pass over the data infers it.  ``null_text`` is
    the text that stands for a missing value.  Blank lines give no row.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    return reader.csv(path)


def scan_json(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """JSON objects, one per line; keys absent from a line become null.

    Without a schema Spark reads the files once more to infer one.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def json_schema(df: DataFrame, column: str) -> str:
    """Schema (DDL) that fits every JSON string of a column, found in one aggregate."""
    merged = df.agg(F.schema_of_variant_agg(F.parse_json(F.col(column))).alias("s")).first()["s"]
    return merged.replace("OBJECT<", "STRUCT<")


def scan_json_strings(
    df: DataFrame, column: str, schema: Schema | None = None, into: str = "parsed"
) -> DataFrame:
    """Parse a column of JSON strings, nested objects included, into a struct column."""
    return df.withColumn(into, F.from_json(F.col(column), schema or json_schema(df, column)))


def scan_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet files; ``merge_schema`` unites the columns of all files, missing ones null."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.parquet(*paths)


def scan_path_sql(
    spark: SparkSession, path: str, columns: Sequence[str] = ("*",), source: str = "parquet"
) -> DataFrame:
    """SQL straight over the files of a folder."""
    if "`" in path:
        raise ValueError("a path must not hold a backtick")
    return spark.sql(f"SELECT {', '.join(columns)} FROM {source}.`{path}`")


def scan_partitioned(
    spark: SparkSession, base_path: str, schema: Schema | None = None
) -> DataFrame:
    """Parquet under ``key=value`` folders.

    Partition columns are typed from the folder names; a declared schema fixes
    their types instead.
    """
    reader = spark.read.option("basePath", base_path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(base_path)


def scan_libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    """Labelled sparse vectors; give the vector size to save a pass over the data."""
    reader = spark.read.format("libsvm")
    if features is not None:
        reader = reader.option("numFeatures", features)
    return reader.load(path)


def scan_images(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file: its ``path`` and the struct ``image``, null where no image can be read.

    Files of no bytes give no row, as with every file source.
    """
    reader = spark.read.format("image").option("dropInvalid", False)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(path)
    readable = (F.col("image.height") > 0) & (F.octet_length("image.data") > 0)
    return found.select(F.col("image.origin").alias("path"), F.when(readable, F.col("image")).alias("image"))


def shared_files(spark: SparkSession, path: str) -> Callable[[], tuple[pyarrow.fs.FileSystem, str]]:
    """What gives a task the file system of a path and the path in it.

    The scheme is settled here, on the driver, by Spark's own default file system: a bare
    path or ``file:`` is a folder of the machine only where that is Spark's default too.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = str(files.makeQualified(place).toString())

    def opened() -> tuple[pyarrow.fs.FileSystem, str]:
        if full.startswith("file:"):
            return pyarrow.fs.LocalFileSystem(), "/" + full[len("file:") :].lstrip("/")
        return pyarrow.fs.FileSystem.from_uri(full.replace("s3a://", "s3://", 1))

    return opened


def sink_text(df: DataFrame, path: str, line: F.Column) -> None:
    """Write one line per row."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def sink_delimited(df: DataFrame, path: str, sep: str, null_text: str = "") -> None:
    """Write rows as separated fields."""
    df.write.mode("overwrite").option("sep", sep).option("nullValue", null_text).csv(path)


def sink_json(df: DataFrame, path: str) -> None:
    """Write one JSON object per line."""
    df.write.mode("overwrite").json(path)


def sink_parquet(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
) -> None:
    """Write or append Parquet, optionally into ``key=value`` folders.

    For folders the rows are first rebalanced by key: small folders get few files, and
    adaptive execution splits a large one over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def sink_libsvm(df: DataFrame, path: str) -> None:
    """Write columns ``label`` and ``features`` as sparse labelled vectors."""
    df.select("label", "features").write.mode("overwrite").format("libsvm").save(path)


def sink_matrix_csv(entries: DataFrame, path: str) -> None:
    """Write a matrix held as ``(i, j, v)`` entries as CSV, one entry per line."""
    entries.select("i", "j", "v").write.mode("overwrite").csv(path)
