"""Embedding whitening from a covariance weighted by multiplicity.

Equal vectors are grouped first.  Every distinct one enters the covariance once, with its
count (or one) as its weight, is whitened once, and its result is joined back to all rows
that hold it.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Batches, mapped, usual_length
from millrace.session import materialise

SCALE = 1024
SHIFT = 100_000

# A component whose variance is below this share of all variance is rounding noise.
NO_VARIANCE = 1e-13

HALF = 24  # bits

WEIGHTS = ("counts", "one")


def quantised(
    vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id`` and ``x`` = floor(scale * c) + shift, c as double, of every usable vector.

    A vector that is null, empty, or holds a null, NaN or infinite entry, or one whose x
    would not fit 62 bits, takes no part.  A row without an id does.
    """
    c = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    most = F.lit(2.0**62 / scale)
    usable = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < most))
    whole = F.transform("c", lambda v: F.floor(v * F.lit(float(scale))) + F.lit(shift))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), c.alias("c"))
        .filter((F.size("c") > 0) & usable)
        .select("vec_id", whole.alias("x"))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _largest(values: np.ndarray) -> int:
    """The largest absolute value, as a Python integer."""
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))


def _square_sums(rows: np.ndarray) -> list[int]:
    """The exact sum of squares of every row: in halves of 64 bits where all sums fit, else in Python integers."""
    width = rows.shape[1]
    high, low = rows >> HALF, rows & (2**HALF - 1)
    if rows.dtype == object or width * max(_largest(high), 2**HALF) ** 2 >= 2**63:
        return [sum(int(v) ** 2 for v in row) for row in rows]
    parts = ((a * b).sum(axis=1).tolist() for a, b in ((high, high), (high, low), (low, low)))
    return [(hh << 2 * HALF) + (hl << HALF + 1) + ll for hh, hl, ll in zip(*parts)]


def _sums(distinct: DataFrame, width: int) -> tuple[int, list[int]]:
    """The sum of the weights and, exactly, the weighted sum of every dimension."""

    def run(batches: Batches) -> Batches:
        total, sums = 0, [0] * width
        for batch in batches:
            w = batch.column("weight").to_numpy(zero_copy_only=False)
            x = _matrix(batch.column("x"), width)
            if _largest(x) * int(w.sum()) >= 2**63:
                x, w = x.astype(object), w.astype(object)
            total += int(w.sum())
            sums = [a + int(b) for a, b in zip(sums, w @ x)]
        values = pa.array([Decimal(s) for s in [total, *sums]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), values], ["dim", "total"])

    parts = mapped(distinct.select("x", "weight"), run, "dim int, total decimal(38,0)")
    found = {r["dim"]: int(r["total"]) for r in parts.groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(width)]


def _added(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of one square matrix a task, given as rows ``i, part`` with i the number of a matrix row."""

    def run(batches: Batches) -> Batches:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), _matrix(batch.column("part"), width)):
                sums[i] = sums[i] + row if i in sums else row
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([r.tolist() for r in sums.values()], pa.list_(pa.float64()))], ["i", "part"]
            )

    out = np.zeros((width, width))
    for r in mapped(parts.repartition(F.col("i")), run, "i int, part array<double>").collect():
        out[r["i"]] += r["part"]
    return out


def _gram(rows: DataFrame, column: str, centre: np.ndarray, width: int, total: int) -> np.ndarray:
    """Covariance with divisor ``total``: weighted product of the centred rows, one matrix a task."""

    def run(batches: Batches) -> Batches:
        gram = np.zeros((width, width))
        for batch in batches:
            c = _matrix(batch.column(column), width) - centre
            w = batch.column("weight").to_numpy(zero_copy_only=False).astype(np.float64)
            gram += (c * w[:, None]).T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(gram.tolist(), pa.list_(pa.float64()))], ["i", "part"]
        )

    parts = mapped(rows.select(column, "weight"), run, "i int, part array<double>")
    return _added(parts, width) / total


@dataclass(frozen=True)
class Fit:
    """What one fit gives: ``n`` rows of weight, exact sums, and components by falling variance."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues
    axes: np.ndarray  # one unit eigenvector a column
    trace: float


def fit(distinct: DataFrame, width: int, components: int) -> Fit | None:
    """Fit on distinct vectors ``x`` of ``width`` entries with a ``weight``; None without rows.

    Only sums and one matrix of width x width reach the driver, whatever the rows.  The
    matrix is shifted by whole numbers before it is centred, so no digits are lost.
    """
    n, sums = _sums(distinct, width)
    if not n:
        return None
    floor = [s // n for s in sums]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            low = np.array(floor, np.int64 if _largest(x) < 2**61 else object)
            near = (x.astype(low.dtype) - low).astype(np.float64)
            flat = pa.array(near.ravel())
            offsets = pa.array(np.arange(len(near) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, flat), batch.column("weight")], ["x", "weight"])

    near = mapped(distinct.select("x", "weight"), run, "x array<double>, weight long")
    rest = np.array([(s - n * f) / n for s, f in zip(sums, floor)])
    covariance = _gram(near, "x", rest, width, n)
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    return Fit(n, sums, values[order], axes[:, order], float(np.trace(covariance)))


def _whitened(distinct: DataFrame, fitted: Fit) -> DataFrame:
    """Adds ``z``, one whitened value a component (0 without variance), and the exact ``deviation``; vectors once each."""
    width, n = len(fitted.sums), fitted.n
    floor = [s // n for s in fitted.sums]
    rest = np.array([(s - n * f) / n for s, f in zip(fitted.sums, floor)])
    left = [s - n * f for s, f in zip(fitted.sums, floor)]
    varies = fitted.values > NO_VARIANCE * fitted.trace
    project = fitted.axes * np.where(varies, 1 / np.sqrt(np.where(varies, fitted.values, 1.0)), 0.0)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            exact = _largest(x) >= 2**61
            near = x.astype(object) - np.array(floor, object) if exact else x - np.array(floor, np.int64)
            z = (near.astype(np.float64) - rest) @ project
            if n * (_largest(near) + 1) >= 2**63:
                near = near.astype(object)
            squares = _square_sums(n * near - np.array(left, near.dtype))
            deviation = [Decimal(d) if d < 10**38 else None for d in squares]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"),
                    batch.column("weight"),
                    pa.array(z.tolist(), pa.list_(pa.float64())),
                    pa.array(deviation, pa.decimal128(38, 0)),
                ],
                ["x", "weight", "z", "deviation"],
            )

    schema = "x array<long>, weight long, z array<double>, deviation decimal(38,0)"
    return mapped(distinct.select("x", "weight"), run, schema)


def identity_error(whitened: DataFrame, fitted: Fit) -> float:
    """The largest absolute entry of the covariance of ``z`` minus the identity, over components with variance."""
    k = len(fitted.values)
    varies = np.flatnonzero(fitted.values > NO_VARIANCE * fitted.trace)
    if not len(varies):
        return 0.0
    sums = [F.sum(F.get("z", i) * F.col("weight")).alias(f"s{i}") for i in range(k)]
    mean = np.array(list(whitened.agg(*sums).first())) / fitted.n
    covariance = _gram(whitened, "z", mean, k, fitted.n)
    return float(np.abs(covariance - np.eye(k))[np.ix_(varies, varies)].max())


def weight_of(kind: str) -> Column:
    if kind not in WEIGHTS:
        raise ValueError(f"weights are one of {WEIGHTS}")
    return F.count(F.lit(1)).alias("weight") if kind == "counts" else F.lit(1).cast("long").alias("weight")


def whiten(vectors: DataFrame, components: int = 8, weights: str = "counts", width: int | None = None) -> DataFrame:
    """One row for every vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``vectors`` holds ``vec_id`` and integer vectors ``x`` (see ``quantised``).  ``weights``:
    a distinct vector counts as often as it occurs, or once.  Over the fit list of weight
    n with sums S: ``deviation`` is the exact sum of (n x - S)^2, ``whitened`` the
    projection of x - S/n on the component over the root of its eigenvalue, ``explained``
    that eigenvalue's share of the trace, ``identity_error`` how far the covariance of the
    whitened values is from the identity.

    Only vectors of ``width`` entries take part (None: the length of most).  Ids may be null or
    repeated, every row gets its own result.  With fewer dimensions than components there
    are as many components as dimensions.  A component without variance has whitened 0 and
    stays out of ``identity_error``; without any variance, ``explained`` is null.  A
    deviation of more than 38 digits is null.  An empty table gives an empty one.
    """
    rows = materialise(vectors.select("vec_id", "x"), "vectors")
    width = usual_length(rows, "x") if width is None else width
    rows = rows.filter(F.size("x") == width)
    distinct = materialise(rows.groupBy("x").agg(weight_of(weights)), "distinct")
    fitted = fit(distinct, width, components) if width else None
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    whitened = materialise(_whitened(distinct, fitted), "whitened")
    error = identity_error(whitened, fitted)
    shares = [F.lit(float(v) / fitted.trace) if fitted.trace > 0 else F.lit(None).cast("double") for v in fitted.values]
    each = rows.join(whitened.drop("weight"), "x").select("vec_id", "deviation", F.posexplode("z").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*shares), F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
