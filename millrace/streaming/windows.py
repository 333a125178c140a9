"""Event-time windows.

Spark merges counts per window and key within each task before the shuffle, so a hot
key costs one row per task and window.  In append mode a window is emitted once, when
the watermark has passed its end; rows later than that are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.topn import top_n_per_group


def window_aggregate(
    df: DataFrame, time: str, length: str, slide: str | None, *keys: str, **aggregates: Column
) -> DataFrame:
    """Aggregates per (sliding) window and key, with columns ``start`` and ``end``."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    grouped = df.groupBy(window.alias("window"), *keys).agg(
        *[c.alias(n) for n, c in aggregates.items()]
    )
    return _with_bounds(grouped, *keys, *aggregates)


def _with_bounds(grouped: DataFrame, *columns: str) -> DataFrame:
    return grouped.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *columns
    )


def pane_aggregate(
    df: DataFrame, time: str, length: str, slide: str, *keys: str, **aggregates: tuple[Column, Column]
) -> DataFrame:
    """Sliding aggregates from panes: rows are folded once per ``slide``, windows add up panes.

    Each aggregate is a pair: over the rows of a pane, and over the column of that name of the
    panes of a window, such as ``n=(count("*"), sum("n"))``.  No row is copied into the
    windows it belongs to; the panes are, one row per key and slide at most, however many
    rows they hold.  ``length`` must be a whole number of slides.
    """
    if _micros(df, length) % _micros(df, slide):
        raise ValueError(f"{length} is no multiple of {slide}")
    panes = df.groupBy(F.window(time, slide).alias("pane"), *keys).agg(
        *(first.alias(n) for n, (first, _) in aggregates.items())
    )
    window = F.window(F.window_time("pane"), length, slide).alias("window")
    grouped = panes.groupBy(window, *keys).agg(*(then.alias(n) for n, (_, then) in aggregates.items()))
    return _with_bounds(grouped, *keys, *aggregates)


def _micros(df: DataFrame, span: str) -> int:
    """The length of a fixed interval such as ``10 minutes``, in microseconds."""
    start = "TIMESTAMP '2000-01-01'"
    value = f"unix_micros({start} + INTERVAL {span}) - unix_micros({start})"
    return df.sparkSession.range(1).select(F.expr(value)).first()[0]


def sliding_count(
    df: DataFrame, time: str, *keys: str, length: str = "60 seconds", slide: str = "10 seconds"
) -> DataFrame:
    """Rows per key over the last ``length``, every ``slide``; no zero counts."""
    return pane_aggregate(df, time, length, slide, *keys, n=(F.count("*"), F.sum("n")))


def top_per_window(
    counts: DataFrame, measure: str, tie_break: str, n: int, *groups: str
) -> DataFrame:
    """The ``n`` largest rows of each window (and group).

    For a whole result or one micro-batch of closed windows, where row numbers are
    allowed; a window in append mode is never split over batches.
    """
    return top_n_per_group(
        counts, ["start", "end", *groups], [F.desc(measure), F.asc(tie_break)], n
    )


def chained_peak(
    df: DataFrame, time: str, short: str, long: str
) -> DataFrame:
    """The busiest short window within each long one: an aggregate over an aggregate."""
    first = df.groupBy(F.window(time, short).alias("w")).agg(F.count("*").alias("n"))
    outer = F.window(F.window_time("w"), long)
    return first.groupBy(outer.alias("window")).agg(
        F.max("n").alias("peak"), F.sum("n").alias("total")
    ).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), "peak", "total"
    )


def join_within(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    span: str,
    salts: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join two streams on a key where the right row is at most ``span`` later.

    Both need a watermark; the time bound lets old state go.  ``how`` is inner or left: a left
    row without a partner is emitted once, with nulls, when the watermark has passed the
    time in which one could have come.

    A stream join cannot split a skewed key by itself.  An inner join splits every key by time, into
    slots as long as ``span``: a right row goes to its own slot, a left row to the two that its partners
    can fall into, so the state holds no more than two copies of it.  Where a batch covers less than a
    few spans and a key is hot, name ``salts``: the rows of one side are then spread over that many parts
    of every key and those of the other are sent to each part, left rows in an inner
    join, right rows in a left one (8 parts by default), where each left row must meet all its
    partners in one place.  The parts depend on the rows alone: after a restart stored
    rows and new ones still meet.  ``salts`` must stay the same for a checkpoint.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")

    parts = 8 if salts is None else salts

    def slot(time: Column) -> Column:
        return F.floor(F.unix_micros(time) / F.lit(max(1, _micros(left, span)))).cast("long")

    def spread(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int"))

    def copied(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    end = F.col(left_time) + F.expr(f"INTERVAL {span}")
    if how == "inner" and salts is None:
        first = left.withColumn("_left_part", F.explode(F.sequence(slot(F.col(left_time)), slot(end))))
        second = right.withColumn("_right_part", slot(F.col(right_time)))
    elif how == "inner":
        first, second = copied(left, "_left_part"), spread(right, "_right_part")
    else:
        first, second = spread(left, "_left_part"), copied(right, "_right_part")
    condition = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("_left_part") == F.col("_right_part"))
        & (F.col(right_time) >= F.col(left_time))
        & (F.col(right_time) <= end)
    )
    return first.join(second, condition, how).drop("_left_part", "_right_part")


def join_static(
    stream: DataFrame, static: DataFrame, on: str, how: str = "inner", salts: int = 8
) -> DataFrame:
    """Join a stream with a table on one column; ``how`` is inner, left or left_anti.

    Stream rows of every key are spread over ``salts`` parts and the table is copied to
    each, so a key that a third of the stream shares is met in ``salts`` tasks.  The join
    is a merge: the optimiser takes the copies as small as the table's files, and would hold all of them in every task.
    """
    columns = [c for c in stream.columns if c != on]
    part = F.pmod(F.xxhash64(on, *columns), F.lit(salts)).cast("int").alias("_part")
    copies = static.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    added = [] if how == "left_anti" else [c for c in static.columns if c != on]
    return stream.select("*", part).join(copies.hint("merge"), [on, "_part"], how).select(*stream.columns, *added)
