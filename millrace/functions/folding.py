"""Helpers of pandas operators: combining rows inside a task, stacking vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Batches = Iterator[pa.RecordBatch]
Frames = Iterator[pd.DataFrame]
Fold = Callable[[pd.DataFrame], pd.DataFrame]

# Combined rows a task holds before it passes them on.
HELD_ROWS = 100_000


def exact_frame(batch: pa.RecordBatch) -> pd.DataFrame:
    """A frame that keeps Arrow's types: whole numbers beside nulls stay whole."""
    return batch.to_pandas(types_mapper=pd.ArrowDtype)


def fold_batches(
    combine: Fold, merge: Fold, schema: T.StructType | str, held_rows: int | None = HELD_ROWS
) -> Callable[[Batches], Batches]:
    """A ``mapInArrow`` function that reduces each task's rows to few.

    ``combine`` turns raw rows into combined ones (say, one per key) with the given
    ``schema``, ``merge`` folds combined rows further; both get frames of Arrow types.  A
    task with too many keys to hold passes on what it has, unless ``held_rows`` is None.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Batches) -> Batches:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = combine(exact_frame(batch))
            held = fresh if held is None else merge(pd.concat([held, fresh], ignore_index=True))
            if held_rows is not None and len(held) > held_rows:
                yield from as_batches(held, arrow)
                held = None
        if held is not None:
            yield from as_batches(held, arrow)

    return run


def as_batches(frame: pd.DataFrame, schema: pa.Schema) -> list[pa.RecordBatch]:
    return pa.Table.from_pandas(frame[schema.names], schema, preserve_index=False).to_batches()


def stacked(vectors: pd.Series, width: int) -> np.ndarray:
    """A column of vectors as a matrix; a missing vector becomes a row of NaN."""
    missing = np.full(width, np.nan)
    return np.array([missing if v is None else v for v in vectors]).reshape(-1, width)
