"""Sliding windows of a stream from one state, which holds panes.

``windows.pane_aggregate`` on a stream keeps a second state with a row for each window and key: as
many times the panes as a window has slides, put in and taken out again in no order of time.  Here the state
closes panes, and every micro-batch adds up the windows that end in it as a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming import sinks, windows

# Windows are added up in stretches of time of so many lengths; a pane is copied to those it reaches into.
STRETCH = 5

Aggregates = Mapping[str, tuple[Column, Column]]


def count_rows() -> Aggregates:
    """The number of rows, as ``n``."""
    return {"n": (F.count("*"), F.sum("n"))}


def closing_panes(df: DataFrame, time: str, length: str, slide: str, keys: Sequence[str], aggregates: Aggregates) -> DataFrame:
    """One row per pane and key, emitted when the watermark has passed the pane's ``end``.

    Every ``end`` of a window that holds rows also has a row without keys or with them (``_pane`` is false
    for those that are only such a mark): the largest one emitted tells which windows are closed.
    """
    end = F.col("_window.end")
    last = end <= F.col(time) + F.expr(f"INTERVAL {slide}")
    marked = df.withColumn("_window", F.window(time, length, slide)).withColumn("_pane", last)
    kept = [F.when(F.col("_pane"), F.col(k)).alias(k) for k in keys]
    grouped = marked.groupBy("_window", "_pane", *kept).agg(*(first.alias(n) for n, (first, _) in aggregates.items()))
    return grouped.select(end.alias("end"), "_pane", *keys, *aggregates)


def windows_between(
    panes: DataFrame,
    length: int,
    slide: int,
    keys: Sequence[str],
    aggregates: Aggregates,
    after: int | None,
    until: int,
    together: Sequence[str] | None = None,
) -> DataFrame:
    """Windows that end later than ``after`` and not later than ``until``; all times are microseconds.

    Panes are dealt once, by stretch of time and the keys in ``together`` (all by default), and are copied into
    windows where they then are, so neither windows nor copies are shuffled.
    """
    stretch = length * STRETCH
    end = F.unix_micros("end")
    first = end if after is None else F.greatest(end, F.lit(after + slide))
    last = F.least(end + F.lit(length - slide), F.lit(until).cast("long"))
    reach = panes.filter("_pane").select(*keys, *aggregates, first.alias("_first"), last.alias("_last"))
    reach = reach.filter("_first <= _last")
    number = [F.floor(F.col(c) / F.lit(stretch)).cast("long") for c in ("_first", "_last")]
    dealt = reach.withColumn("_stretch", F.explode(F.sequence(*number))).repartition(
        "_stretch", *(keys if together is None else together)
    )
    begin = F.col("_stretch") * F.lit(stretch)
    ends = F.sequence(
        F.greatest("_first", begin), F.least("_last", begin + F.lit(stretch - slide)), F.lit(slide).cast("long")
    )
    copies = dealt.select("_stretch", *keys, *aggregates, F.explode(ends).alias("_end"))
    added = copies.groupBy("_stretch", "_end", *keys).agg(*(then.alias(n) for n, (_, then) in aggregates.items()))
    return added.select(
        F.timestamp_micros(F.col("_end") - F.lit(length)).alias("start"), F.timestamp_micros("_end").alias("end"),
        *keys, *aggregates,
    )


def per_window(
    df: DataFrame,
    path: str,
    time: str,
    length: str,
    slide: str,
    keys: Sequence[str],
    aggregates: Aggregates,
    transform: sinks.BatchFunction | None = None,
    together: Sequence[str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write sliding windows to ``path/batch=N``, each once, in the batch whose watermark passes its end.

    The rows are those of ``windows.pane_aggregate`` in append mode, or what ``transform`` makes of a batch of them.
    ``df`` needs a watermark.  Panes that later windows need are kept as the table ``path-open/batch=N``, made from
    that of batch N - 1 and the panes closed in batch N alone, so a repeated batch gives the same rows.
    """
    full, step = windows._micros(df, length), windows._micros(df, slide)
    if full % step:
        raise ValueError(f"{length} is no multiple of {slide}")
    closing = closing_panes(df, time, length, slide, keys, aggregates)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in closing.schema.fields])

    def latest(panes: DataFrame) -> int | None:
        return panes.agg(F.max(F.unix_micros("end"))).first()[0]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        none = spark.createDataFrame([], schema)
        batch.write.mode("overwrite").parquet(f"{path}-panes/batch={batch_id}")
        closed = spark.read.schema(schema).parquet(f"{path}-panes/batch={batch_id}")
        opened = spark.read.schema(schema).parquet(f"{path}-open/batch={batch_id - 1}") if batch_id else none
        until = latest(closed)
        if until is None:
            added, later = windows_between(none, full, step, keys, aggregates, None, 0, together), opened
        else:
            known = closed.unionByName(opened)
            added = windows_between(known, full, step, keys, aggregates, latest(opened), until, together)
            later = known.filter(F.unix_micros("end") > F.lit(until - full + step))
        result = added if transform is None else transform(added, batch_id)
        if result is not None:
            result.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        later.write.mode("overwrite").parquet(f"{path}-open/batch={batch_id}")
        sinks.remove(spark, f"{path}-panes/batch={batch_id}")
        if batch_id > 1:
            sinks.remove(spark, f"{path}-open/batch={batch_id - 2}")

    return sinks.start(closing, path, "append", trigger, lambda writer: writer.foreachBatch(run))


def run_windows(
    df: DataFrame, path: str, time: str, length: str, slide: str, keys: Sequence[str], aggregates: Aggregates
) -> DataFrame:
    """All closed windows of the available input."""
    sinks.finish(per_window(df, path, time, length, slide, keys, aggregates))
    schema = windows.pane_aggregate(df, time, length, slide, *keys, **aggregates).schema
    return sinks.read_batches(df.sparkSession, path, schema).drop("batch")
