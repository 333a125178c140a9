"""Stream sources.

An operator takes a streaming DataFrame and does not care where it comes from, so
a file source can stand in for a socket or a broker in tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import read_table


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    source: str = "parquet",
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """Files that appear in a folder (or match a glob) become rows, ``max_files`` per trigger."""
    reader = spark.readStream.schema(schema).format(source).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_table(
    spark: SparkSession, base: str, name: str, max_files: int | None = None
) -> DataFrame:
    """A Parquet table, whether one file or a folder, read as a stream."""
    schema = read_table(spark, base, name).schema
    # The source wants a folder or a glob, so the name is written as a glob for itself.
    return stream_files(spark, f"{base}/{name}.parque[t]", schema, max_files=max_files)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket, in column ``value``; for trials only, as nothing is replayed."""
    return (
        spark.readStream.format("socket").option("host", host).option("port", port).load()
    )


def kafka_options(
    servers: Sequence[str],
    topics: Sequence[str],
    start: str = "latest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a broker source: which topics, from where, how much per trigger."""
    options = {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": ",".join(topics),
        "startingOffsets": start,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_kafka(
    spark: SparkSession,
    servers: Sequence[str],
    topics: Sequence[str],
    start: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Message texts of topics, with offsets kept in the query's checkpoint.

    This is also the successor of consumer-group receivers.  The connector package
    has to be on the session's class path.
    """
    raw = spark.readStream.format("kafka").options(
        **kafka_options(servers, topics, start, max_offsets)
    )
    return raw.load().select(F.col("value").cast("string").alias("value"))


def with_event_time(df: DataFrame, column: str = "ts", delay: str | None = None) -> DataFrame:
    """Make a clock-time column usable as event time, optionally with a watermark."""
    timed = df.withColumn(column, F.col(column).cast("timestamp"))
    return timed if delay is None else timed.withWatermark(column, delay)
