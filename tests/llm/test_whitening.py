"""Whitening against plain exact sums and the definition of a covariance."""

from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import queries, whitening


def table(spark, rows):
    """Vectors beside extra columns with the operator's own names."""
    return spark.createDataFrame(
        [(i, v, "x", 3, "w", 1.5) for i, v in rows],
        "vec_id long, embedding array<float>, x string, n int, weight string, whitened double",
    )


def sample(n=300, width=10, copies=90):
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(n, width)) * np.linspace(0.05, 1, width) @ rng.normal(size=(width, width)) / 4).astype(np.float32)
    rows[:copies] = rows[0]
    return [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(10 * n)[:n], rows)]


def by_row(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_equals_definition(spark, weights):
    data = sample()
    got = by_row(whitening.whiten(whitening.quantised(table(spark, data)), weights=weights))
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for _, v in data])
    fitted = x if weights == "counts" else np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = fitted - fitted.mean(axis=0)
    covariance = centred.T @ centred / n
    values = np.sort(np.linalg.eigvalsh(covariance))[::-1]
    assert set(got) == {i for i, _ in data}
    z = np.array([[got[i][k + 1]["whitened"] for k in range(8)] for i, _ in data])
    for (i, _), row in zip(data, x):
        assert sorted(got[i]) == list(range(1, 9))
        first = got[i][1]
        assert first["n"] == n and int(first["deviation"]) == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        assert np.allclose([got[i][k + 1]["explained"] for k in range(8)], values[:8] / np.trace(covariance), rtol=1e-9)
    # z are the projections on unit eigenvectors over the roots of their values: the axes follow from z itself
    axes = np.linalg.lstsq(x - fitted.mean(axis=0), z * np.sqrt(values[:8]), rcond=None)[0]
    assert np.allclose(np.linalg.norm(axes, axis=0), 1, atol=1e-8)
    assert np.allclose(covariance @ axes, axes * values[:8], atol=1e-6 * values[0])
    own = z if weights == "counts" else np.unique(np.round(z, 9), axis=0)
    assert np.abs(own.T @ own / n - np.eye(8)).max() < 1e-6
    assert all(r["identity_error"] < 1e-9 for c in got.values() for r in c.values())


def test_unusable_repeated_and_null_ids(spark):
    inf, nan = float("inf"), float("nan")
    usable = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [-1.0, 0.125]), (4, [2.0, -3.0])]
    others = [(5, None), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, []), (10, [1.0]), (11, [3e38, 1.0])]
    rows = whitening.whiten(whitening.quantised(table(spark, usable + others))).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (4, 1), (4, 2)]
    assert {r["n"] for r in rows} == {4}
    assert len({(r["component"], r["whitened"]) for r in rows if r["vec_id"] == 1}) == 2


def test_no_variance_and_empty(spark):
    same = whitening.quantised(table(spark, [(i, [0.5, 1.0]) for i in range(5)]))
    rows = whitening.whiten(same).collect()
    assert len(rows) == 10
    assert all(r["whitened"] == 0 and r["deviation"] == 0 and r["explained"] is None and r["identity_error"] == 0 for r in rows)
    line = whitening.whiten(whitening.quantised(table(spark, [(i, [float(i), 1.0]) for i in range(5)]))).collect()
    assert {r["whitened"] for r in line if r["component"] == 2} == {0.0} and line[0]["identity_error"] < 1e-9
    empty = whitening.whiten(same.limit(0))
    assert empty.count() == 0 and empty.columns == rows[0].__fields__


def test_sums_beyond_64_bits(spark):
    big = 2**61 - 3
    vectors = spark.createDataFrame([(i, [big - i * 7, -big + i]) for i in range(6)], "vec_id long, x array<long>")
    rows = whitening.whiten(vectors).collect()
    x = [[big - i * 7, -big + i] for i in range(6)]
    sums = [sum(c) for c in zip(*x)]
    for r in rows:
        assert int(r["deviation"]) == sum((6 * a - s) ** 2 for a, s in zip(x[r["vec_id"]], sums))
    spread = max(abs(float(Fraction(a) - Fraction(s, 6))) for v in x for a, s in zip(v, sums))
    assert spread < 100 and rows[0]["identity_error"] < 1e-6
    wide = np.array([[3, -5], [2**45, -(2**45)], [2**61, 2**60]], np.int64)
    assert whitening._square_sums(wide) == [sum(int(v) ** 2 for v in row) for row in wide]
    assert whitening._square_sums(wide[:2]) == [34, 2**91]


def test_query_columns(spark, tmp_path):
    table(spark, sample(60)).write.parquet(str(tmp_path / "embeddings.parquet"))
    df = queries.op11_embedding_whitening(spark, str(tmp_path))
    assert dict(df.dtypes) == {
        "vec_id": "bigint",
        "component": "int",
        "n": "bigint",
        "deviation": "bigint",
        "whitened": "double",
        "explained": "double",
        "identity_error": "double",
    }
    assert df.filter("deviation is not null").count() == 60 * 8
