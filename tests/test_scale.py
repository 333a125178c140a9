"""Work is shared out: hot keys are split, whole-table orders have no single task."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import matrices
from millrace.functions import udfs as U
from millrace.ml import metrics
from millrace.operators import aggregates as A
from millrace.operators import joins as J
from millrace.operators import ranking
from millrace.operators import topn as W
from millrace.session import materialise, scratch_path, shared_root
from millrace.streaming import windows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 0."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7 % 101).alias("v"),
    )


def plan(df):
    return df._jdf.queryExecution().toString()


def test_group_values_are_whole_and_split_alike_for_every_key(skewed):
    grouped = A.group_values(skewed, "k", "v", "id", parts=8).collect()
    hot = sorted(v for r in grouped if r["k"] == 0 for v in r["values"])
    assert hot == sorted(r.v for r in skewed.filter("k = 0").collect())
    assert sum(len(r["values"]) for r in grouped) == 3000
    assert all(r["values"] == sorted(r["values"]) and 0 <= r["part"] < 8 for r in grouped)
    assert max(len(r["values"]) for r in grouped) < len(hot) / 8 * 1.5


def test_group_values_spread_ids_that_are_multiples_of_the_parts(spark):
    ids = spark.range(0, 4000, 4).select(F.lit(1).alias("k"), "id", F.col("id").alias("v"))
    sizes = [len(r["values"]) for r in A.group_values(ids, "k", "v", "id", parts=4).collect()]
    assert len(sizes) == 4 and max(sizes) < 320 and sum(sizes) == 1000


def test_large_top_n_is_cut_within_parts_first(skewed, collected):
    order = [F.desc("v"), F.asc("id")]
    large = W.top_n_per_group(skewed, "k", order, 1001, salts=4)
    assert "_part" in plan(large)
    whole = skewed.withColumn("rank", F.row_number().over(W.Window.partitionBy("k").orderBy(*order)))
    assert collected(large) == collected(whole.filter("rank <= 1001"))


def test_small_top_n_is_cut_before_the_shuffle(skewed):
    text = plan(W.top_n_per_group(skewed, "k", [F.desc("v"), F.asc("id")], 3))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hot_keys(skewed):
    assert J.hot_keys(skewed, "k", 0.3) == [0]
    assert J.hot_keys(skewed, "id") == []


def test_semi_join_keys_are_folded_before_their_shuffle(skewed, spark, collected):
    left = spark.range(60).withColumnRenamed("id", "k")
    got = J.join_semi(left, skewed.select("k"), "k")
    assert collected(got) == [(k,) for k in range(50)]
    assert "keys=[k" in plan(got) and "_salt" in plan(got)


@pytest.mark.parametrize("ranges", [1, 2, 7, None])
def test_global_row_number_equals_a_window(spark, collected, ranges):
    df = spark.range(500).select((F.col("id") * 37 % 1009).alias("x"))
    expected = spark.sql("SELECT x, row_number() OVER (ORDER BY x) AS row_no FROM {df}", df=df)
    got = ranking.global_row_number(df, "x", ranges=ranges)
    assert collected(got) == collected(expected)


def test_global_row_number_of_strings_and_nulls(spark, collected):
    words = [(f"{c}{i}",) for c in "zöaÄ中" for i in range(20)] + [(None,)]
    df = spark.createDataFrame(words, "w string").repartition(3)
    expected = spark.sql("SELECT w, row_number() OVER (ORDER BY w) AS row_no FROM {df}", df=df)
    assert collected(ranking.global_row_number(df, "w", ranges=6)) == collected(expected)


def test_global_order_uses_several_ranges(spark):
    cut = ranking.sorted_ranges(spark.range(1000), ["id"], 8)
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 400


def test_a_value_on_half_the_rows_takes_up_several_ranges(spark, collected):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("x"), F.col("id").alias("y"))
    cut = ranking.sorted_ranges(df, ["x"], 8)
    assert cut.filter("x = 7").select("_range").distinct().count() >= 3
    assert max(r["count"] for r in cut.groupBy("_range").count().collect()) < 1500
    got = ranking.global_row_number(df, "x", tie_break=["y"], ranges=8)
    expected = spark.sql("SELECT x, y, row_number() OVER (ORDER BY x, y) AS row_no FROM {df}", df=df)
    assert collected(got) == collected(expected)
    free = collected(ranking.global_row_number(df, "x", ranges=8))
    assert sorted(r[2] for r in free) == list(range(1, 4001)) and [r[0] for r in sorted(free, key=lambda r: r[2])] == sorted(r[0] for r in free)


def test_whole_table_order_of_nothing_and_of_equal_rows(spark, collected):
    df = spark.createDataFrame([(1, "a")] * 9 + [(None, None)] * 2, "x int, w string")
    assert collected(ranking.global_row_number(df.limit(0), "x")) == []
    got = collected(ranking.global_row_number(df, "x", ranges=5))
    assert sorted(r[2] for r in got) == list(range(1, 12)) and all((r[0] is None) == (r[2] <= 2) for r in got)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(0, 9)), min_size=1, max_size=60))
def test_running_sum_property(spark, pairs):
    df = spark.createDataFrame(pairs, "x int, n int").groupBy("x").agg(F.sum("n").alias("n"))
    got = {r.x: r.t for r in ranking.global_running_sum(df, "x", {"n": "t"}, ranges=4).collect()}
    for x, t in got.items():
        assert t == sum(n for y, n in pairs if y <= x)


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), min_size=6, max_size=50)
       .filter(lambda r: 0 < sum(y for _, y in r) < len(r)))
def test_roc_area_counts_ties_half(spark, rows):
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "score double, label int")
    assert math.isclose(metrics.curve_areas(df, "score", "label").first().roc_area, brute_auc(rows))


def test_curve_areas_agree_with_hard_form(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1), (0, 0)], "p int, label int")
    soft, hard = metrics.curve_areas(df, "p", "label").first(), metrics.curve_areas_hard(df, "p", "label").first()
    assert math.isclose(soft.roc_area, hard.roc_area) and math.isclose(soft.pr_area, hard.pr_area)


def test_long_rankings_are_numbered_in_blocks(spark, monkeypatch, collected):
    predicted = spark.createDataFrame([("u", i, i) for i in range(1, 41)], "user string, item int, rank int")
    actual = spark.createDataFrame([("u", i) for i in range(3, 41, 4)], "user string, item int")
    whole = metrics.average_precision(predicted, actual, "user", "item").first().ap
    monkeypatch.setattr(metrics, "RANK_BLOCK", 7)
    blocked = metrics.average_precision(predicted, actual, "user", "item").first().ap
    hits = [i for i in range(3, 41, 4)]
    assert math.isclose(whole, sum((n + 1) / r for n, r in enumerate(hits)) / len(hits))
    assert math.isclose(whole, blocked)


def test_custom_aggregate_folds_in_tasks(spark, skewed, collected):
    def update(keys):
        return lambda frame: frame.groupby(keys, as_index=False, dropna=False).agg(n=("v", "size"), s=("v", "sum"))

    def merge(keys):
        return lambda frame: frame.groupby(keys, as_index=False, dropna=False).agg(n=("n", "sum"), s=("s", "sum"))

    out = {"n": F.col("n"), "s": F.col("s")}
    two = skewed.withColumn("k2", F.col("k") % 2)
    got = U.custom_aggregate(two, ["k", "k2"], ["v"], update(["k", "k2"]), merge(["k", "k2"]), "n long, s long", out)
    assert collected(got) == collected(two.groupBy("k", "k2").agg(F.count("*"), F.sum("v")))
    large = skewed.withColumn("k", F.when(F.col("k") > 2, F.col("k") + 2**53))
    got = U.custom_aggregate(large, ["k"], ["v"], update(["k"]), merge(["k"]), "n long, s long", out)
    assert collected(got) == collected(large.groupBy("k").agg(F.count("*"), F.sum("v")))


def test_scratch_space_is_the_shared_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_root(spark))


def test_scratch_space_must_be_named_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="shared"):
        shared_root(Session())


def test_materialised_table_is_equal(spark, skewed, collected):
    assert collected(materialise(skewed, "m")) == collected(skewed)


def test_ranks_of_a_group_with_a_third_of_all_rows(spark, collected):
    group = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50)
    df = spark.range(3000).select(group.alias("g"), ((F.col("id") * 37) % 501).alias("x"), F.col("id"))
    cut = ranking.sorted_ranges(df, ["g", "x", "id"], 12)
    assert cut.filter("g = 7").select("_range").distinct().count() >= 4
    got = ranking.rank_within(df, "g", ["x", "id"], ranges=12)
    expected = spark.sql("SELECT g, x, id, row_number() OVER (PARTITION BY g ORDER BY x, id) AS rank FROM {df}", df=df)
    assert collected(got) == collected(expected)
    assert ranking.rank_within(df.limit(0), "g", ["x"]).count() == 0


@pytest.mark.parametrize("tile, band", [(4, 1), (4, 64), (64, 2)])
def test_product_of_tiles(spark, monkeypatch, tile, band):
    monkeypatch.setattr(matrices, "BAND_TILES", band)
    monkeypatch.setattr(matrices, "HELD_TILES", 2)
    rng = np.random.default_rng(tile)
    a, b = np.zeros((41, 17)), np.zeros((17, 23))
    left, right = [], []
    for m, rows, n in ((a, left, 300), (b, right, 90)):
        for _ in range(n):  # places may repeat
            i, j, v = int(rng.integers(m.shape[0])), int(rng.integers(m.shape[1])), int(rng.integers(-4, 5))
            m[i, j] += v
            rows.append((i - 9 if m is a else i, j, float(v)))
    left.append((5, 3, None))
    frame = lambda rows: spark.createDataFrame(rows, "i long, j long, v double").repartition(3)
    got = {(r.i, r.j): r.v for r in matrices.multiply_tiles(frame(left), frame(right), tile).collect()}
    stored = {(i, j) for i, k, v in left for n, j, _ in right if k == n and v is not None}
    assert set(got) == stored and all(got[(i, j)] == (a @ b)[i + 9, j] for i, j in stored)
    assert matrices.multiply_tiles(frame(left).limit(0), frame(right), tile).count() == 0


@pytest.mark.parametrize("dense", [0, 10**9])
def test_products_send_no_copy_of_the_right_matrix_to_every_band(spark, monkeypatch, dense):
    monkeypatch.setattr(matrices, "DENSE", dense)
    frame = lambda rows: spark.createDataFrame(rows, "i long, j long, v double")
    left = frame([(1000 * i, i % 7, 1.0 + i % 3) for i in range(400)])
    right = frame([(k, j, float(k - j)) for k in range(6) for j in range(5)])
    got = matrices.multiply_tiles(left, right, 4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan and "SortMergeJoin" in plan
    want = {(1000 * i, j): (1.0 + i % 3) * (i % 7 - j) for i in range(400) if i % 7 < 6 for j in range(5)}
    assert {(r.i, r.j): r.v for r in got.collect()} == want


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_copies_of_a_static_table_are_not_sent_to_every_task(spark, collected, tmp_path, how):
    spark.range(20).selectExpr("id as k", "id * 2 as x").write.parquet(str(tmp_path / "static"))
    static = spark.read.parquet(str(tmp_path / "static"))
    rows = spark.range(50).selectExpr("id", "id % 30 as k")
    joined = windows.join_static(rows, static, "k", how)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert collected(joined) == collected(rows.join(static, "k", how).select(*joined.columns))


@pytest.mark.parametrize("tile, kind", [(matrices.TILE, "smallint"), (2048, "int")])
def test_right_rows_travel_as_short_places_beside_their_values(spark, monkeypatch, tile, kind):
    stored, keep = {}, matrices.materialise
    monkeypatch.setattr(matrices, "materialise", lambda df, label: stored.setdefault(label, keep(df, label)))
    columns = [-(2**40), -32769, -32768, -1, 0, 32767, 32768, 131071, 131072, 2**40 + 5]
    right = spark.createDataFrame([(1, j, float(n + 1)) for n, j in enumerate(columns)] + [(2, 7, 0.5)], "i long, j long, v double")
    left = spark.createDataFrame([(-5, 1, 2.0), (40000, 1, 3.0), (40000, 2, 4.0)], "i long, j long, v double")
    got = {(r.i, r.j): r.v for r in matrices.multiply_tiles(left, right, tile).collect()}
    want = {(i, j): v * (n + 1) for i, v in ((-5, 2.0), (40000, 3.0)) for n, j in enumerate(columns)} | {(40000, 7): 2.0}
    assert got == want
    assert dict(stored["right-rows"].dtypes) == {"k": "bigint", "slice": "bigint", "js": f"array<{kind}>", "ws": "array<double>"}
