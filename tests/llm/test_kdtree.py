"""Exact search against all scores."""

import numpy as np
import pytest

from millrace.llm import kdtree


def brute(ids, rows, asked, k):
    out = {}
    for i in asked:
        score = rows @ rows[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), int(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("kind", ["spread", "ties", "copies"])
def test_equals_all_scores(spark, kind):
    rng = np.random.default_rng(3)
    rows = rng.integers(-200, 200, (700, 6)) if kind == "spread" else rng.integers(-1, 2, (700, 6))
    if kind == "copies":
        rows[:300] = rows[0]
    ids = rng.permutation(5000)[:700]
    vectors = spark.createDataFrame([(int(i), [int(x) for x in v]) for i, v in zip(ids, rows)], "vec_id long, v array<long>")
    asked = [j for j, i in enumerate(ids) if i % 7 == 0]
    got = found(kdtree.top_k(vectors, vectors.filter("vec_id % 7 = 0"), 5, shard_rows=150, leaf_rows=16))
    assert got == brute(ids, rows, asked, 5)


def test_scores_beyond_doubles(spark):
    big = 2**31 - 1
    rows = [(1, [big, big]), (2, [big, big - 1]), (3, [big - 1, big]), (4, [-big, -big])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = found(kdtree.top_k(vectors, vectors.filter("vec_id = 1"), 2))
    assert got == {1: [(2, big * big + big * (big - 1)), (3, big * big + big * (big - 1))]}


def test_fewer_than_k_and_unusable_vectors(spark):
    rows = [(0, [0.5, -0.25]), (1, [1.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<float>, v string, shard int")
    whole = kdtree.quantised(table)
    assert sorted((r["vec_id"], r["v"]) for r in whole.collect()) == [(0, [128, -64]), (1, [256, 256])]
    assert found(kdtree.top_k(whole, whole, 5)) == {0: [(1, 128 * 256 - 64 * 256)], 1: [(0, 128 * 256 - 64 * 256)]}
    assert kdtree.top_k(whole.limit(0), whole.limit(0)).count() == 0


def test_unequal_lengths(spark):
    rows = [(0, [1, 2]), (50, [3, 1]), (1, [2, 2]), (2, []), (3, [9, 9, 9, 9]), (100, [7]), (150, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(3)
    got = found(kdtree.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5))
    assert got == {0: [(1, 6), (50, 5)], 50: [(1, 8), (0, 5)]}
    assert kdtree.top_k(vectors.filter("vec_id = 2"), vectors, 5).count() == 0


def test_queries_go_only_where_a_box_can_beat_them(spark, monkeypatch):
    """Clusters far apart: the shards of the others are never visited."""
    rng = np.random.default_rng(9)
    centres = np.array([(a, b, 0) for a in (1000, -1000) for b in (1000, -1000)])
    rows = np.concatenate([c + rng.integers(0, 5, (200, 3)) for c in centres])
    vectors = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, v array<long>")
    visits = []
    inner = kdtree._in_shards

    def counted(dealt, queries, *rest):
        visits.append(queries.count())
        return inner(dealt, queries, *rest)

    monkeypatch.setattr(kdtree, "_in_shards", counted)
    got = found(kdtree.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 5, shard_rows=200, leaf_rows=16))
    assert got == brute(np.arange(800), rows, range(0, 800, 20), 5)
    assert visits == [40, 0]  # 40 queries, and 3 other shards for each


def test_regions_share_out_a_sample():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(4000, 5)).round(2)
    tree = kdtree.regions((sample * 100).astype(np.int64), 13)
    sizes = np.bincount(tree.of((sample * 100).astype(np.int64)))
    assert len(sizes) == 13 and sizes.min() > 100 and sizes.max() < 700
    skewed = np.array([[5, 1]] * 900 + [[i, 2] for i in range(5)], np.int64)
    parts = np.bincount(kdtree.regions(skewed, 4).of(skewed))
    assert len(parts) >= 3 and parts.max() <= 901
    assert kdtree.regions(np.zeros((10, 3), np.int64), 4).of(np.ones((2, 3), np.int64)).tolist() == [0, 0]


def test_boxes_are_tight_and_cover_their_rows():
    rng = np.random.default_rng(1)
    rows = rng.integers(-50, 50, (333, 4))
    tree = kdtree.build(np.arange(333), rows, 10)
    for n in range(len(tree.child)):
        part = tree.rows[tree.start[n] : tree.end[n]]
        assert (part.min(0) == tree.low[n]).all() and (part.max(0) == tree.high[n]).all()
        assert tree.least_id[n] == tree.ids[tree.start[n] : tree.end[n]].min()
    leaves = [(tree.start[n], tree.end[n]) for n in range(len(tree.child)) if tree.child[n] < 0]
    assert sum(b - a for a, b in leaves) == 333 and max(b - a for a, b in leaves) <= 10
