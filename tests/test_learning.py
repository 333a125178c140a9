"""Models do what they should: better than guessing, equal to brute force where one exists."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.functions import matrices as M
from millrace.ml import classify, cluster, features, metrics, recommend, reduce, regress, shards

RNG = np.random.default_rng(3)
POINTS = [
    (i, int(i % 2), [float(v) for v in RNG.normal(loc=2.0 * (i % 2), size=4)]) for i in range(240)
]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "id long, y int, x array<double>").cache()


@pytest.fixture(scope="module")
def labelled(points):
    return features.labelled(points, F.col("y"), F.col("x")).cache()


@pytest.mark.parametrize("estimator", [
    classify.logistic_regression, classify.linear_svm, classify.decision_tree
])
def test_classifiers_beat_the_majority(labelled, estimator):
    scored = classify.fit_and_score(estimator(), labelled)
    assert metrics.classification_accuracy(scored, F.col("prediction"), F.col("label")).first()[0] > 0.85


def test_naive_bayes_agrees_with_counts(points):
    positive = points.select(F.col("y"), F.transform("x", lambda v: F.abs(v)).alias("x"))
    rows = features.labelled(positive, F.col("y"), F.col("x"))
    model = classify.naive_bayes(1.0).fit(rows)
    counted = classify.naive_bayes_parameters(rows.select("label", vector_to_array("features").alias("features")))
    theta = model.theta.toArray()
    for r in counted.collect():
        assert math.isclose(r.theta, theta[int(r.label), r.pos], abs_tol=1e-9)
        assert math.isclose(r.pi, model.pi[int(r.label)], abs_tol=1e-9)


def test_curve_areas_agree_with_the_evaluator(labelled):
    scored = classify.fit_and_score(classify.logistic_regression(), labelled)
    flat = scored.select("label", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score"))
    ours = metrics.curve_areas(flat, "score", "label").first()
    for name, metric in (("roc_area", "areaUnderROC"), ("pr_area", "areaUnderPR")):
        theirs = BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(scored)
        assert math.isclose(ours[name], theirs, abs_tol=1e-9)


def test_hard_curve_areas_agree_with_the_evaluator(labelled):
    scored = classify.fit_and_score(classify.decision_tree(2), labelled)
    ours = metrics.curve_areas_hard(scored, "prediction", "label").first()
    for name, metric in (("roc_area", "areaUnderROC"), ("pr_area", "areaUnderPR")):
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="prediction", metricName=metric)
        assert math.isclose(ours[name], evaluator.evaluate(scored), abs_tol=1e-9)


def test_linear_regression_saved_and_loaded(spark, tmp_path):
    rows = [(3.0 * i - 2, [float(i)]) for i in range(20)]
    df = spark.createDataFrame(rows, "label double, x array<double>")
    df = df.select("label", array_to_vector("x").alias("features"))
    model = regress.linear_regression_fit(df)
    again = regress.save_and_load(model, str(tmp_path / "m"))
    assert math.isclose(again.coefficients[0], 3.0) and math.isclose(again.intercept, -2.0, abs_tol=1e-9)
    scored = classify.score_table(again, df)
    assert metrics.regression_eval(scored, "prediction", "label").first().rmse < 1e-6


def test_sweep_and_holdout(labelled):
    sweep = classify.param_sweep(labelled, [("depth", d, classify.decision_tree(d)) for d in (1, 3)])
    areas = {r.value: r.auc for r in sweep.collect()}
    assert areas[3.0] >= areas[1.0] > 0.5
    held = classify.holdout_validation(labelled, regs=(0.0, 0.01)).collect()
    assert len(held) == 2 and held[0].auc >= held[1].auc > 0.9


def test_scaling_and_one_hot(points, spark):
    x = np.array([p[2] for p in POINTS])
    scaled = features.standard_scale(points, "x", "z").orderBy("id")
    np.testing.assert_allclose([r.z for r in scaled.collect()], (x - x.mean(0)) / x.std(0, ddof=1))
    cats = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("c", 3.0)], "c string, n double")
    made = features.one_hot_category(cats, "c", ["n"]).orderBy("c").collect()
    assert [list(r.features.toArray()) for r in made] == [[1, 0, 0, 2], [0, 1, 0, 1], [0, 0, 1, 3]]


def test_kmeans_step_matches_brute_force(points, monkeypatch):
    start = points.filter("id < 3").select(F.col("id").cast("int").alias("cluster"), F.col("x").alias("centre"))
    x, c = np.array([p[2] for p in POINTS]), np.array([p[2] for p in POINTS[:3]])
    nearest = ((x[:, None] - c) ** 2).sum(2).argmin(1)
    for few in (True, False):
        monkeypatch.setattr(shards, "SHIPPED_ROWS", 3 if few else 2)
        monkeypatch.setattr(shards, "SHARD_BYTES", 1)
        monkeypatch.setattr(shards, "BUCKET_ROWS", 100)
        step = {r.cluster: r for r in cluster.kmeans_one_step(points, "x", start).collect()}
        for k in range(3):
            assert step[k].n == (nearest == k).sum()
            np.testing.assert_allclose(step[k].centre, x[nearest == k].mean(0))


def test_start_is_a_race_and_steps_follow_lloyd(spark, points):
    import hashlib

    x = {p[0]: np.array(p[2], float) for p in POINTS}
    drawn = []
    for draw in range(4):
        times = {}
        for i, v in x.items():
            u = 1 - int(hashlib.md5(f"{i}|{9 + draw}".encode()).hexdigest()[:8], 16) / 2**32
            gap = min((((v - x[d]) ** 2).sum() for d in drawn), default=1.0)
            if gap > 0:
                times[i] = (-math.log(u) / gap, i)
        drawn.append(min(times, key=times.get))
    start = cluster.kmeans_start(points, "id", "x", 4, seed=9)
    assert [r.id for r in start.orderBy("cluster").collect()] == drawn
    centres = np.array([x[d] for d in drawn])
    all_x = np.array(list(x.values()))
    for _ in range(3):
        near = ((all_x[:, None] - centres) ** 2).sum(2).argmin(1)
        centres = np.array([all_x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(4)])
    got = cluster.kmeans_steps(points, "x", start, 3).orderBy("cluster").collect()
    np.testing.assert_allclose([r.centre for r in got], centres)
    assert [r.n for r in got] == [(near == c).sum() for c in range(4)]


def test_start_with_few_different_vectors(spark):
    rows = spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(9)] + [(20, None), (None, [5.0, 5.0])], "id int, x array<double>")
    start = cluster.kmeans_start(rows, "id", "x", 5)
    assert sorted(r.centre for r in start.collect()) == [[0.0, 0.0], [1.0, 0.0]]
    far = spark.createDataFrame([(0, [0.0, 0.0]), (1, [99.0, 0.0])], "cluster int, centre array<double>")
    steps = cluster.kmeans_steps(rows.filter("id < 9"), "x", far, 2).orderBy("cluster").collect()
    assert [(r.cluster, r.n) for r in steps] == [(0, 9), (1, 0)] and steps[1].centre == [99.0, 0.0]
    assert cluster.kmeans_start(rows.limit(0), "id", "x", 3).count() == 0


def test_missing_vectors(spark, collected, monkeypatch):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 2.0])], "id int, x array<double>")
    centres = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "cluster string, centre array<double>")
    for shipped in (1, 10):
        monkeypatch.setattr(shards, "SHIPPED_ROWS", shipped)
        near = cluster.nearest_centre(rows, "x", centres).select("id", "cluster", "distance")
        assert collected(near) == [(1, "a", 0.0), (2, None, None), (3, "b", 1.0)]
    none = cluster.nearest_centre(rows, "x", centres.limit(0)).select("id", "cluster", "distance")
    assert collected(none) == [(1, None, None), (2, None, None), (3, None, None)]
    entries = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0)], "i long, j long, v double")
    product = M.multiply_rows(rows, "x", entries, "y", (2, 1)).select("id", "y")
    assert collected(product) == [(1, [1.0]), (2, None), (3, [6.0])]
    assert M.axis_sum(M.gram(rows, "x")).first()[0] == 5.0
    best = recommend.top_scored_items(rows.toDF("u", "f"), rows.toDF("i", "f"), "u", "i", "f", 1)
    assert collected(best.select("u", "i")) == [(1, 1), (3, 3)]


def test_cost_falls_with_more_clusters(points):
    rows = points.select("id", array_to_vector("x").alias("features"))
    costs = cluster.wcss_by_k(rows.filter("id % 5 < 3"), rows.filter("id % 5 >= 3"), ks=(2, 8), runs=2)
    by_k = {r.k: r.wcss for r in costs.collect()}
    assert by_k[8] < by_k[2]
    model = cluster.kmeans_fit(rows, k=2)
    centres = cluster.centre_table(model, rows)
    ours = cluster.nearest_centre(points, "x", centres).agg(F.sum("distance")).first()[0]
    assert math.isclose(ours, model.summary.trainingCost, rel_tol=1e-6)


def test_members_and_profile(points, spark):
    near = cluster.members_near_centre(points, "id", "y", "x", 5)
    assert near.groupBy("y").count().select("count").distinct().first()[0] == 5
    wcss = cluster.cluster_wcss(points, "y", "x").agg(F.sum("wcss")).first()[0]
    x, y = np.array([p[2] for p in POINTS]), np.array([p[1] for p in POINTS])
    expected = sum(((x[y == k] - x[y == k].mean(0)) ** 2).sum() for k in (0, 1))
    assert math.isclose(wcss, expected)
    titles = spark.range(240).withColumn("title", F.concat(F.lit("t"), "id"))
    assert cluster.cluster_profile(points, titles, "id", "y", "x").count() == 240


def test_principal_components_equal_singular_vectors_up_to_sign(points, spark):
    centred = features.standard_scale(points, "x", "z", with_std=False)
    rows = centred.select(array_to_vector("z").alias("features"))
    components = reduce.components_table(reduce.pca_fit(rows, 2), spark)
    values, right = reduce.svd_topk(centred, "z", 2)
    assert M.approx_equal(components, right).first().equal
    x = np.array([p[2] for p in POINTS])
    s = np.linalg.svd(x - x.mean(0), compute_uv=False)[:2]
    np.testing.assert_allclose([r.s for r in values.orderBy("j").collect()], s)


def test_left_vectors_rebuild_the_rows(points):
    centred = features.standard_scale(points, "x", "z", with_std=False)
    width = len(POINTS[0][2])
    values, right = reduce.svd_topk(centred, "z", width)
    rows = reduce.svd_left(centred, "z", values, right, width).orderBy("id").collect()
    x = np.array([p[2] for p in POINTS])
    v = np.zeros((width, width))
    for r in right.collect():
        v[r.i, r.j] = r.v
    us, u = (np.array([r[c] for r in rows]) for c in ("us", "u"))
    np.testing.assert_allclose(us @ v.T, x - x.mean(0), atol=1e-9)
    np.testing.assert_allclose(u.T @ u, np.eye(width), atol=1e-9)


def test_top_scored_items_match_brute_force(spark, monkeypatch):
    u, v = RNG.normal(size=(23, 3)), RNG.normal(size=(17, 3))
    users = spark.createDataFrame([(f"u{i:02}", list(map(float, r))) for i, r in enumerate(u)], "user string, f array<double>")
    items = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(v)], "item int, f array<double>")
    monkeypatch.setattr(recommend, "SLICE", 3)
    scores = u @ v.T
    monkeypatch.setattr(recommend, "BLOCK", 4)
    monkeypatch.setattr(shards, "BUCKET_ROWS", 10)
    for shipped, held in ((10**6, 10**6), (5, 10**6), (5, 100)):  # all items sent; one shard; four items to a shard
        monkeypatch.setattr(shards, "SHIPPED_ROWS", shipped)
        monkeypatch.setattr(shards, "SHARD_BYTES", held)
        # A user on two rows and an item on two rows count once.
        got = recommend.top_scored_items(users.union(users.limit(3)), items.union(items.limit(5)), "user", "item", "f", 4)
        assert got.count() == 23 * 4
        ranked = {(r.user, r["rank"]): r.item for r in got.collect()}
        for i in range(23):
            assert [ranked[(f"u{i:02}", n)] for n in range(1, 5)] == list(np.argsort(-scores[i])[:4])
    assert recommend.top_scored_items(users, items.limit(0), "user", "item", "f", 4).count() == 0


def test_short_items_are_not_scored():
    """A user whose kth score no shorter item can reach stops there."""
    rng = np.random.default_rng(4)
    matrix = rng.normal(size=(5000, 8)) * np.linspace(9, 0.001, 5000)[:, None]
    items = recommend._Items(np.arange(5000), matrix[::-1])

    class Counted(np.ndarray):
        rows = 0

        def __getitem__(self, part):
            if isinstance(part, slice):
                Counted.rows += part.stop - part.start
            return np.asarray(super().__getitem__(part))

    items.matrix = items.matrix.view(Counted)
    users = rng.normal(size=(50, 8))
    recommend.BLOCK, before = 100, recommend.BLOCK
    try:
        ids, scores = items.best(users, 5)
    finally:
        recommend.BLOCK = before
    want = users @ matrix[::-1].T
    assert Counted.rows < 5000 and (ids == np.argsort(-want, axis=1)[:, :5]).all()
    np.testing.assert_allclose(scores, -np.sort(-want, axis=1)[:, :5])


def test_equal_scores_go_to_the_smaller_item(spark, collected):
    users = spark.createDataFrame([(1, [1.0])], "u int, f array<double>")
    items = spark.createDataFrame([(i, [1.0]) for i in (9, 4, 7, 2)], "i int, f array<double>")
    got = recommend.top_scored_items(users, items, "u", "i", "f", 2)
    assert collected(got.select("rank", "i")) == [(1, 2), (2, 4)]


def test_recommender(spark):
    rows = [(u, i, float(1 + 4 * ((u + i) % 2 == 0))) for u in range(12) for i in range(10) if (u * i) % 7]
    ratings = spark.createDataFrame(rows, "user_no long, item long, rating double")
    model = recommend.als_fit(ratings, rank=4, iterations=8, reg=0.05)
    scored = recommend.predict_pairs(model, ratings)
    assert metrics.regression_eval(scored, "prediction", "rating").first().rmse < 0.6
    all_users = recommend.recommend_for_all(model, 3)
    assert all_users.groupBy("user_no").count().filter("count <> 3").count() == 0
    one = recommend.recommend_for_users(model, ratings.filter("user_no = 3").select("user_no").distinct(), 3)
    assert [r.item for r in one.orderBy("rank").collect()] == [
        r.item for r in all_users.filter("user_no = 3").orderBy("rank").collect()
    ]
    alike = recommend.similar_items(model.itemFactors, 2, 3)
    ids = [r.id for r in alike.collect()]
    assert 2 not in ids and all(i % 2 == 0 for i in ids)


def test_every_iteration_of_als_drops_the_files_of_the_one_before(spark, monkeypatch):
    monkeypatch.setattr(recommend.ALS, "fit", lambda self, df: self.getCheckpointInterval())
    assert recommend.als_fit(spark.createDataFrame([(1, 1, 1.0)], "user_no int, item int, rating double")) == 1
    assert spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("shard_bytes", [10**9, 100])
def test_products_of_pairs_are_those_of_the_joins(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(shards, "SHARD_BYTES", shard_bytes)
    rng = np.random.default_rng(5)
    tables = {n: spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(n)], "id int, features array<float>") for n in (40, 30)}
    pairs = [(i % 45, (7 * i) % 37, f"r{i}") for i in range(900)] + [(3, 4, "r")] * 300 + [(None, 4, "n"), (3, None, "n"), (99, 99, "n")]
    asked = spark.createDataFrame(pairs, "`a.b` int, it int, note string")
    got = shards.pair_products(asked, tables[40], tables[30], "a.b", "it", "p")
    assert got.columns == ["a.b", "it", "note", "p"]
    vectors = {n: {r.id: np.array(r.features) for r in t.collect()} for n, t in tables.items()}
    want = [(*p, float(vectors[40][p[0]] @ vectors[30][p[1]]) if p[0] in vectors[40] and p[1] in vectors[30] else None) for p in pairs]
    order = lambda r: tuple((x is None, str(x)) for x in r[:3])
    got, want = sorted(map(tuple, got.collect()), key=order), sorted(want, key=order)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all((a[3] is None) == (b[3] is None) and (b[3] is None or abs(a[3] - b[3]) < 1e-5) for a, b in zip(got, want))
    empty = spark.createDataFrame([], "id int, features array<float>")
    assert shards.pair_products(asked, tables[40], empty, "a.b", "it", "p").filter("p is null").count() == len(pairs)


def test_rows_past_one_shard_use_every_core(spark):
    users = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(64)], "id long, vector array<double>")
    items = users.withColumnRenamed("id", "key")
    parts = shards.past_shards(users, items, lambda keys, matrix, ids, rows: pa.RecordBatch.from_arrays([ids], ["id"]), "id long")
    assert parts.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in parts.collect()) == list(range(64))


def test_later_blocks_hold_better_items_and_ties(monkeypatch):
    monkeypatch.setattr(recommend, "BLOCK", 16)
    rng = np.random.default_rng(8)
    matrix, users = rng.integers(-3, 4, (200, 4)).astype(float), rng.integers(-3, 4, (30, 4)).astype(float)
    ids, scores = recommend._Items(np.arange(200), matrix).best(users, 5)
    full = users @ matrix.T
    want = [sorted(range(200), key=lambda i, row=row: (-row[i], i))[:5] for row in full]
    assert ids.tolist() == want and (scores == np.take_along_axis(full, np.array(want), 1)).all()


def test_few_pairs_are_scored_exactly_and_close_scores_keep_their_order(monkeypatch):
    """Scores closer than single precision tells apart, of factors from tiny to huge; most pairs are ruled out before."""
    monkeypatch.setattr(recommend, "BLOCK", 64)
    rng = np.random.default_rng(12)
    for size in (1e-30, 1.0, 1e30):
        base = rng.normal(size=(2000, 6)) * size
        base[::100] = base[0] * 3 * (1 + rng.permutation(20)[:, None] * 1e-12)
        users = np.concatenate([rng.normal(size=(40, 6)) / size, np.zeros((1, 6)), base[:1] / size**2])
        items, scored = recommend._Items(np.arange(2000), base), []
        merged = items._merged
        items._merged = lambda vectors, k, held, fresh: scored.extend(len(o) for o, _ in fresh) or merged(vectors, k, held, fresh)
        ids, scores = items.best(users, 15)
        full = (users[:, None] * base[None]).sum(2)
        assert ids.tolist() == [sorted(range(2000), key=lambda i, row=row: (-row[i], i))[:15] for row in full]
        assert (scores == np.take_along_axis(full, ids, 1)).all()
        assert sum(scored) - 2000 < 0.25 * 2000 * len(users)  # a user of zeros ties with every item
    odd = recommend._Items(np.arange(300), np.concatenate([np.full((1, 2), 1e300), rng.normal(size=(299, 2))]))
    assert odd.best(np.ones((2, 2)), 3)[0][:, 0].tolist() == [0, 0]


def test_rows_past_several_shards_come_in_more_cells_than_cores(spark, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_BYTES", 400)
    users = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(64)], "id long, vector array<float>")
    items = users.withColumnRenamed("id", "key")
    seen = lambda keys, matrix, ids, rows: pa.RecordBatch.from_arrays([ids, pa.array([len(keys)] * len(ids))], ["id", "n"])
    parts = shards.past_shards(users, items, seen, "id long, n long")
    assert parts.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert {r.id: r.n for r in parts.groupBy("id").agg(F.sum("n").alias("n")).collect()} == dict.fromkeys(range(64), 64)


def test_perfect_ranking_has_map_one(spark):
    predicted = spark.createDataFrame([("u", i, i + 1) for i in range(4)], "user string, item int, rank int")
    actual = spark.createDataFrame([("u", i) for i in range(4)], "user string, item int")
    assert metrics.mean_average_precision(predicted, actual, "user", "item").first().map == 1.0
