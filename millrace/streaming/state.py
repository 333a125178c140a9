"""Per-key state kept across micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.folding import HELD_ROWS, Batches, Fold, fold_batches
from millrace.streaming import sinks

Step = Callable[[tuple | None, pd.DataFrame], tuple | None]


def update_state(
    df: DataFrame,
    key: str,
    combine: Fold,
    merge: Fold,
    combined: str,
    step: Step,
    state: T.StructType,
) -> DataFrame:
    """State per key, updated by a function once per key and micro-batch.

    ``combine`` folds raw rows to one row per key with schema ``combined`` and ``merge``
    folds such rows again; both run in the reading tasks, so a hot key is shuffled as
    about one row per task, and once more before ``step``.  ``step`` gets the old state
    (or None) and the key's one combined row and returns the new state, or None to forget
    the key.  Keys without new rows keep their state.  The output has the key, the state
    and ``alive``; run it in update mode.  A forgotten key appears once more with
    ``alive`` false.
    """
    fields = state.fieldNames()
    key_type = df.schema[key].dataType
    output = T.StructType(
        [T.StructField(key, key_type), *state.fields, T.StructField("alive", T.BooleanType())]
    )

    def advance(
        keys: tuple, batches: Iterator[pd.DataFrame], held: GroupState
    ) -> Iterator[pd.DataFrame]:
        current = tuple(held.get) if held.exists else None
        rows = None
        for batch in batches:
            rows = merge(batch if rows is None else pd.concat([rows, batch], ignore_index=True))
        new = step(current, rows)
        alive = new is not None
        if alive:
            held.update(new)
        elif held.exists:
            held.remove()
        last = new if alive else current or (None,) * len(fields)
        yield pd.DataFrame([(keys[0], *last, alive)], columns=output.fieldNames())

    return (
        df.mapInArrow(fold_batches(combine, merge, combined), combined)
        .groupBy(key)
        .applyInPandasWithState(advance, output, state, "update", GroupStateTimeout.NoTimeout)
    )


def update_every_key(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    new: Mapping[str, Column],
    step: Mapping[str, Column],
    state: T.StructType,
    keep: Column | None = None,
    versions: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """State of every known key, stepped once per micro-batch whether or not the key has new rows.

    ``new`` are aggregates over a key's rows in the batch.  ``step`` gives each field of
    ``state`` from the columns ``old.<field>`` and ``new.<name>``: ``old`` is null for a key
    not known before, ``new`` for one without new rows.  Keys whose stepped state fails ``keep``
    are forgotten; they start anew with their next row.  Null keys are keys.

    The state after batch N is the table ``path/batch=N``, made from that of batch N - 1 alone, so
    a repeated batch gives the same rows; read them with ``sinks.read_batches``.  Rows are
    folded in the reading tasks, then one row a key meets its state in a full join.
    ``versions`` older tables are removed (None: all stay; two at least are needed).
    """
    if set(step) != set(state.fieldNames()):
        raise ValueError("a step for each field of the state")
    if versions is not None and versions < 2:
        raise ValueError("the table before the newest must stay")
    if not new:
        raise ValueError("at least one aggregate of new rows")
    schema = T.StructType([*(df.schema[k] for k in keys), *state.fields])

    def advance(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        key = F.struct(*keys).alias("key")
        fresh = batch.groupBy(*keys).agg(F.struct(*(c.alias(n) for n, c in new.items())).alias("new")).select(key, "new")
        if batch_id:
            known = spark.read.schema(schema).parquet(f"{path}/batch={batch_id - 1}")
        else:
            known = spark.createDataFrame([], schema)
        known = known.select(key, F.struct(*state.fieldNames()).alias("old"))
        both = known.join(fresh, known["key"].eqNullSafe(fresh["key"]), "full")
        stepped = both.select(
            F.coalesce(known["key"], fresh["key"]).alias("key"),
            F.struct(*(step[f.name].cast(f.dataType).alias(f.name) for f in state.fields)).alias("state"),
        ).select("key.*", "state.*")
        return stepped if keep is None else stepped.filter(keep)

    def versioned(batch: DataFrame, batch_id: int) -> None:
        advance(batch, batch_id).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if versions is not None and batch_id >= versions:
            sinks.remove(batch.sparkSession, f"{path}/batch={batch_id - versions}")

    return sinks.start(df, path, "append", trigger, lambda writer: writer.foreachBatch(versioned))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows of a stream that have not occurred before; run it in append mode.

    Repeats within a task are dropped before the shuffle, so a row that makes up much
    of the input does not burden one task.  Rows with nested columns are compared after
    the shuffle only.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    if any(isinstance(f.dataType, nested) for f in df.schema.fields):
        return df.distinct()
    return df.mapInArrow(_thinned, df.schema).distinct()


def _thinned(batches: Batches) -> Batches:
    held = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        rows = fresh if held is None else pa.concat_tables([held, fresh])
        held = rows.group_by(rows.column_names).aggregate([]).select(rows.column_names)
        if held.num_rows > HELD_ROWS:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()
