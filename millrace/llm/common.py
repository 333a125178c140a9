"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Batches = Iterator[pa.RecordBatch]


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns ``doc_id`` and ``text`` alone; a null text counts as empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def in_slices(batches: Batches, column: str = "text", most_bytes: int = 8 << 20) -> Batches:
    """Cut Arrow batches so that one holds about ``most_bytes`` of text, or a single longer row.

    Bounds what a task holds beside the batch itself, however long the texts are.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, size in enumerate(x or 0 for x in sizes):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def mapped(df: DataFrame, run: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` that skips empty batches on the way in."""

    def full(batches: Batches) -> Batches:
        return run(b for b in batches if b.num_rows)

    return df.mapInArrow(full, schema)


def numbered(df: DataFrame) -> DataFrame:
    """The columns by place, ``c0, c1, ...``: names with dots or backticks never reach ``mapInArrow``, which refuses them."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be no column of ``df`` (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def usual_length(rows: DataFrame, column: str) -> int:
    """The length that most arrays of a column have, of equally frequent ones the largest; 0 for an empty table.

    Empty and null arrays do not count.
    """
    sizes = rows.select(F.size(column).alias("n")).filter("n > 0").groupBy("n").count()
    most = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    return most["n"] if most else 0
