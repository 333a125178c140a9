"""Matrices as tables.

Long form: one row ``(i, j, v)`` per entry, any size.  Row form: one row per matrix
row with an ``array<double>`` column, for tall matrices with a bounded width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.session import materialise

# Entries of a matrix that is sent to every task: 32 MB of doubles.
MOST_CELLS = 4_000_000
# Rows and columns of a tile, tiles of rows or columns that share a task, tiles of product terms to a part.
TILE, BAND_TILES, HELD_TILES = 512, 64, 16
# Tasks of a product; a product of matrices is taken whole where it costs less than so many multiplications a term.
MOST_TASKS, DENSE = 2000, 64
# Tasks in which the partial sums of all tasks are folded before they meet.
FOLDS = 16


def to_entries(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """Row form to long form, columns numbered from 0."""
    return df.select(
        F.col(row_id).cast("long").alias("i"),
        F.posexplode(V.dense(F.col(vector))).alias("j", "v"),
    ).withColumn("j", F.col("j").cast("long"))


def transpose(entries: DataFrame) -> DataFrame:
    return entries.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def axis_sum(entries: DataFrame, axis: str | None = None) -> DataFrame:
    """Sum of all entries, per column (``"j"``) or per row (``"i"``)."""
    keys = [] if axis is None else [axis]
    return entries.groupBy(*keys).agg(F.sum("v").alias("total"))


def diagonal(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("i") == F.col("j"))


def trace(entries: DataFrame) -> DataFrame:
    return diagonal(entries).agg(F.sum("v").alias("trace"))


def diagonal_matrix(values: DataFrame, index: str, value: str) -> DataFrame:
    """A matrix with the given values on its diagonal (other entries are not stored)."""
    i = F.col(index).cast("long")
    return values.select(i.alias("i"), i.alias("j"), F.col(value).cast("double").alias("v"))


def identity_like(entries: DataFrame) -> DataFrame:
    """The identity of as many rows as the matrix has."""
    return diagonal_matrix(entries.select("i").distinct().withColumn("_v", F.lit(1.0)), "i", "_v")


def lower_triangle(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("i") >= F.col("j"))


def upper_triangle(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("i") <= F.col("j"))


def multiply(left: DataFrame, right: DataFrame, salts: int = 64) -> DataFrame:
    """Product of two long-form matrices, joined on the inner index.

    A tall left matrix has as many entries per inner index as it has rows, so left
    entries are spread by row over ``salts`` parts and the right matrix is sent to each
    part.  The optimiser ships a right matrix that it knows to be small.
    """
    a = left.select("i", F.col("j").alias("_k"), F.col("v").alias("_a"))
    b = right.select(F.col("i").alias("_k"), "j", F.col("v").alias("_b"))
    part = F.pmod(F.xxhash64("i"), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    pairs = a.withColumn("_part", part).join(b.withColumn("_part", copies), ["_k", "_part"])
    return pairs.groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))


def _split(entries: DataFrame, row: str, column: str) -> DataFrame:
    """``row, column, v``: every stored place once; repeated entries are added up."""
    known = entries.filter(F.col("i").isNotNull() & F.col("j").isNotNull() & F.col("v").isNotNull())
    return known.groupBy(F.col("i").cast("long").alias(row), F.col("j").cast("long").alias(column)).agg(F.sum(F.col("v").cast("double")).alias("v"))


class _Sums:
    """Sums of terms by place, put together whenever ``most`` wait."""

    def __init__(self, most: int) -> None:
        self.most, self.waiting, self.parts = most, 0, []

    def add(self, i: np.ndarray, j: np.ndarray, v: np.ndarray) -> None:
        self.parts.append((i, j, v))
        self.waiting += len(v)
        if self.waiting > self.most:
            self.parts = [self.total()]
            self.waiting = 0

    def total(self) -> tuple[np.ndarray, ...]:
        i, j, v = map(np.concatenate, zip(*self.parts))
        low, wide = int(j.min()), int(j.max()) - int(j.min()) + 1
        first, tall = int(i.min()), int(i.max()) - int(i.min()) + 1
        if wide * tall < 2**62:
            order = np.argsort((i - first) * wide + (j - low), kind="stable")
        else:
            order = np.lexsort((j, i))
        i, j, v = i[order], j[order], v[order]
        starts = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        return i[starts], j[starts], np.add.reduceat(v, starts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            columns = [pa.array(c) for c in self.total()]
            self.parts, self.waiting = [], 0
            whole = pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])
            for low in range(0, whole.num_rows, 100_000):
                yield whole.slice(low, 100_000)


def _terms(sums: _Sums, i: np.ndarray, at: np.ndarray, v: np.ndarray, starts: np.ndarray, j: np.ndarray, w: np.ndarray) -> None:
    """Add up left entries ``i, v`` times the right rows ``at``, which lie from ``starts`` on in ``j, w``.

    Many entries a row and column are taken as matrices, few one by one.
    """
    n = (starts[1:] - starts[:-1])[at]
    ends = np.cumsum(n)
    low = 0
    while low < len(i):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + sums.most, "right")))
        part, total = slice(low, high), int(ends[high - 1] - done)
        inner, place = np.unique(at[part], return_inverse=True)
        rows, row = np.unique(i[part], return_inverse=True)
        sizes = (starts[1:] - starts[:-1])[inner]
        own = np.repeat(np.arange(len(inner)), sizes)
        where = np.arange(len(own)) + np.repeat(starts[inner] - (np.cumsum(sizes) - sizes), sizes)
        columns, column = np.unique(j[where], return_inverse=True)
        if len(rows) * len(inner) * len(columns) < DENSE * total:
            a, b = np.zeros((len(rows), len(inner))), np.zeros((len(inner), len(columns)))
            hit_a, hit_b = np.zeros_like(a, np.float32), np.zeros_like(b, np.float32)
            np.add.at(a, (row, place), v[part])
            b[own, column] = w[where]
            hit_a[row, place], hit_b[own, column] = 1, 1
            r, c = np.nonzero(hit_a @ hit_b)
            sums.add(rows[r], columns[c], (a @ b)[r, c])
        else:
            times = n[part]
            left = np.repeat(np.arange(low, high), times)
            where = np.arange(total) + np.repeat(starts[at[part]] - (np.cumsum(times) - times), times)
            sums.add(i[left], j[where], v[left] * w[where])
        low = high


def multiply_tiles(left: DataFrame, right: DataFrame, tile: int = TILE) -> DataFrame:
    """Product of two long-form matrices of any size, by bands of rows multiplied in numpy.

    A band of at most ``BAND_TILES * tile`` rows gets the rows of the right matrix that its entries name, so
    its part of the product is finished in one task and no product term is shuffled.  Bands with many terms are
    dealt on by row, so that a part has about ``HELD_TILES * tile * tile`` terms, or one row; wide right matrices
    go by slices of columns.  A right row travels as the places of its cells in the slice, two bytes each, and their
    values side by side, which compress well.  What is shuffled is at most the smaller of one right row per left entry and one right
    matrix per band.  The join is a merge: by the size of its files alone the right matrix could be sent to
    all tasks.  Entries not stored are 0, repeated ones are added up, null ones left out; the
    result holds the places that have a term.  Numbers of rows and columns may be negative.
    """
    most = HELD_TILES * tile * tile
    a = _split(left, "i", "k")
    wide = BAND_TILES * tile
    columns = F.floor(F.col("j") / wide).cast("long").alias("slice")
    b = _split(right, "k", "j").groupBy("k", columns).agg(F.collect_list(F.struct("j", F.col("v").alias("w"))).alias("cells"))
    place = lambda c: (c["j"] - F.col("slice") * wide).cast("short" if wide <= 1 << 15 else "int")
    b = materialise(b.select("k", "slice", F.transform("cells", place).alias("js"), F.col("cells.w").alias("ws")), "right-rows")
    named = a.join(b.select("k", "slice", F.size("js").alias("n")), "k")
    named = materialise(named.withColumn("band", F.floor(F.col("i") / wide).cast("long")), "left-entries")
    parts = F.ceil(F.sum("n") / most).cast("int").alias("parts")
    load = materialise(named.groupBy("band", "slice").agg(parts), "bands")
    spark, cell = left.sparkSession, ["band", "slice", "part"]
    tasks = max(spark.sparkContext.defaultParallelism, min(MOST_TASKS, load.agg(F.sum("parts")).first()[0] or 1))
    dealt = named.join(load, ["band", "slice"]).withColumn("part", F.pmod(F.xxhash64("i"), F.col("parts")))
    copies = dealt.select(*cell, "k").distinct().join(b.hint("merge"), ["k", "slice"])
    null = lambda c, kind: F.lit(None).cast(kind).alias(c)
    both = copies.select(*cell, "k", null("i", "long"), null("v", "double"), "js", "ws").unionByName(
        dealt.select(*cell, "k", "i", "v", *(null(c, b.schema[c].dataType) for c in ("js", "ws")))
    )
    together = both.repartition(int(tasks), *cell).sortWithinPartitions(*cell, "k", F.col("i").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, now = _Sums(most), None
        last = np.zeros(0, np.int64), np.zeros(0)  # the right row that the rows before ended with
        for batch in batches:
            if not batch.num_rows:
                continue
            i, v = batch.column("i"), batch.column("v")
            entry = i.is_valid().to_numpy(zero_copy_only=False)
            lists = batch.column("js").drop_null()
            sizes = lists.value_lengths().to_numpy()
            starts = np.concatenate([[0, len(last[0])], len(last[0]) + np.cumsum(sizes)]).astype(np.int64)
            first = np.repeat(batch.column("slice").to_numpy()[~entry] * wide, sizes)
            j = np.concatenate([last[0], lists.flatten().to_numpy() + first])
            w = np.concatenate([last[1], batch.column("ws").drop_null().flatten().to_numpy()])
            at = np.cumsum(~entry)[entry]
            i, v = i.drop_null().to_numpy(), v.drop_null().to_numpy()
            places = np.stack([batch.column(c).to_numpy() for c in cell])
            change = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *change], [*change, batch.num_rows]):
                if now is not None and now != tuple(places[:, low]):
                    yield from sums.batches()
                now = tuple(places[:, low])
                own = slice(*(int(entry[:x].sum()) for x in (low, high)))
                _terms(sums, i[own], at[own], v[own], starts, j, w)
            last = j[starts[-2] :], w[starts[-2] :]
        yield from sums.batches()

    return together.mapInArrow(run, "i long, j long, v double")


def multiply_rows(
    df: DataFrame, vector: str, right: DataFrame, into: str, shape: tuple[int, int]
) -> DataFrame:
    """Each row vector times a long-form matrix of the given ``shape``.

    Entries that are not stored are 0, repeated ones are added up.  A missing vector has
    no product; one whose length is not the matrix's height, and an entry outside the
    shape, are errors.  The matrix goes to every task, so it may have ``MOST_CELLS``
    cells; for a larger one use :func:`multiply_tiles`.
    """
    height, width = shape
    if height * width > MOST_CELLS:
        raise ValueError(f"a matrix of {height} x {width} is too large to send to every task; use multiply_tiles")
    inside = F.col("i").between(0, height - 1) & F.col("j").between(0, width - 1)
    # One row a matrix row, and one more for an entry outside: no more than the shape holds reaches the driver.
    rows = (
        right.groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .select(F.when(inside, F.col("i")).alias("i"), F.when(inside, F.col("j")).alias("j"), F.when(inside, F.col("v")).alias("v"), F.when(~inside, F.struct("i", "j")).alias("out"))
        .groupBy("i")
        .agg(F.min("out").alias("out"), F.collect_list(F.when(F.col("out").isNull(), F.struct("j", "v"))).alias("cells"))
        .collect()
    )
    matrix = np.zeros(shape)
    for e in rows:
        if e["out"] is not None:
            raise ValueError(f"entry ({e['out']['i']}, {e['out']['j']}) lies outside {height} x {width}")
        for j, v in e["cells"]:
            matrix[e["i"], j] = v

    @F.pandas_udf("array<double>")
    def product(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            known = [v for v in batch if v is not None]
            if any(len(v) != height for v in known):
                raise ValueError(f"vectors must have {height} components, as the matrix has rows")
            rows = iter(np.stack(known) @ matrix if known else ())
            yield pd.Series([None if v is None else next(rows) for v in batch], dtype=object)

    return df.withColumn(into, product(V.dense(F.col(vector))))


def elementwise(
    left: DataFrame, right: DataFrame, op: Callable[[Column, Column], Column]
) -> DataFrame:
    """Combine the entries at the same place of two matrices; an entry not stored is 0.

    The result holds a place that either matrix stores.
    """
    a = left.select("i", "j", F.col("v").alias("_a"))
    b = right.select("i", "j", F.col("v").alias("_b"))
    x, y = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("_a", "_b"))
    return a.join(b, ["i", "j"], "full").select("i", "j", op(x, y).alias("v"))


def column(entries: DataFrame, j: int) -> DataFrame:
    return entries.filter(F.col("j") == j).select("i", "v")


def assign_block(
    entries: DataFrame, rows: tuple[int, int], columns: tuple[int, int], value: float
) -> DataFrame:
    """Set the entries of a block (bounds included) to a number."""
    inside = F.col("i").between(*rows) & F.col("j").between(*columns)
    return entries.withColumn("v", F.when(inside, F.lit(float(value))).otherwise(F.col("v")))


def stack(upper: DataFrame, lower: DataFrame, height: int | Column) -> DataFrame:
    """One matrix below another of the given ``height``, stored or not."""
    below = height if isinstance(height, Column) else F.lit(height)
    return upper.select("i", "j", "v").unionByName(
        lower.select((F.col("i") + below).cast("long").alias("i"), "j", "v")
    )


def beside(left: DataFrame, right: DataFrame, width: int | Column) -> DataFrame:
    """One matrix to the right of another of the given ``width``, stored or not."""
    return transpose(stack(transpose(left), transpose(right), width))


def gram(df: DataFrame, vector: str) -> DataFrame:
    """XᵀX of a row-form matrix, in long form.

    Each task adds up its own rows into one packed matrix.  These are folded in
    ``FOLDS`` tasks before entries are made, so the number of entries that are shuffled
    does not grow with the number of tasks.
    """

    def added(matrices: Iterator[np.ndarray]) -> Iterator[pd.DataFrame]:
        total = None
        for matrix in matrices:
            total = matrix if total is None else total + matrix
        if total is not None:
            yield pd.DataFrame({"g": [total.ravel()]})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stacks = (np.stack(b["x"].to_numpy()) for b in batches if len(b))
        return added(x.T @ x for x in stacks)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return added(g for b in batches for g in b["g"])

    rows = df.select(V.dense(F.col(vector)).alias("x")).filter(F.col("x").isNotNull())
    sums = rows.mapInPandas(partial, "g array<double>").repartition(FOLDS).mapInPandas(fold, "g array<double>")
    cells = sums.select(F.posexplode("g").alias("p", "v"), F.sqrt(F.size("g")).cast("long").alias("w"))
    place = [F.floor(F.col("p") / F.col("w")).cast("long").alias("i"), (F.col("p") % F.col("w")).cast("long").alias("j")]
    return cells.select(*place, "v").groupBy("i", "j").agg(F.sum("v").alias("v"))


def approx_equal(left: DataFrame, right: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Whether two matrices have the same entries up to sign, as one row.

    An entry present on one side only makes them unequal.
    """
    a = left.select("i", "j", F.col("v").alias("_a"))
    b = right.select("i", "j", F.col("v").alias("_b"))
    close = F.abs(F.abs(F.col("_a")) - F.abs(F.col("_b"))) <= tolerance
    return a.join(b, ["i", "j"], "full").agg(
        F.coalesce(F.bool_and(F.coalesce(close, F.lit(False))), F.lit(True)).alias("equal"),
        F.count_if(F.coalesce(close, F.lit(False))).alias("n_equal"),
    )
