"""Models and metrics (L)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.functions import matrices as M
from millrace.functions import vectors as V
from millrace.ml import certificates, classify, cluster, features, metrics, recommend, reduce, regress
from millrace.operators import joins as J
from millrace.operators import ranking
from millrace.operators import sampling as X
from millrace.operators.topn import top_n_per_group
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import materialise, read_table, scratch_path


def _labelled(spark, base):
    """Embeddings with a 0/1 label, as ML vectors."""
    return features.labelled(
        read_table(spark, base, "embeddings"), (F.col("label") >= 5).cast("int"), F.col("embedding")
    )


def _non_negative(spark, base):
    positive = F.transform(F.col("embedding"), lambda x: F.greatest(x, F.lit(0.0).cast("float")))
    return features.labelled(
        read_table(spark, base, "embeddings"), (F.col("label") >= 5).cast("int"), positive
    )


def _prices(spark, base):
    """Line prices in thousands over quantities."""
    return read_table(spark, base, "lineitem").select(
        "l_orderkey",
        (F.col("l_extendedprice") / 1000).alias("label"),
        array_to_vector(F.array("l_quantity")).alias("features"),
    )


def _graded(spark, base):
    """Documents with a quality label, a length score and a 0/1 guess from it."""
    documents = read_table(spark, base, "documents").select("doc_id", "n_chars")
    return documents.join(read_table(spark, base, "labels"), "doc_id").select(
        "doc_id",
        F.col("quality").alias("label"),
        F.col("n_chars").alias("score"),
        F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("guess"),
    )


GRADED_SQL = """WITH graded AS (SELECT doc_id, quality AS label, n_chars AS score,
    CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS guess FROM documents JOIN labels USING (doc_id)) """


@query(
    "l01_linear_regression_fit",
    "SELECT round(regr_slope(l_extendedprice / 1000, l_quantity), 6) AS slope, "
    "round(regr_intercept(l_extendedprice / 1000, l_quantity), 6) AS intercept FROM lineitem",
)
def linear_regression_fit(spark, base):
    model = regress.linear_regression_fit(_prices(spark, base), solver="normal")
    row = [(float(model.coefficients[0]), float(model.intercept))]
    fitted = spark.createDataFrame(row, "slope double, intercept double")
    return fitted.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(
    "l02_regression_eval",
    "SELECT round(avg(pow(l_quantity * 1.5 - l_extendedprice / 1000, 2)), 6) AS mse, "
    "round(sqrt(avg(pow(l_quantity * 1.5 - l_extendedprice / 1000, 2))), 6) AS rmse FROM lineitem",
)
def regression_eval(spark, base):
    guessed = read_table(spark, base, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("label"),
        (F.col("l_quantity") * 1.5).alias("prediction"),
    )
    result = metrics.regression_eval(guessed, "prediction", "label")
    return result.select(F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"))


@query(
    "l03_model_save_load",
    "SELECT count(*) AS n, count(*) AS n_same FROM lineitem",
)
def model_save_load(spark, base):
    prices = _prices(spark, base)
    model = regress.linear_regression_fit(prices)
    loaded = regress.save_and_load(model, scratch_path(spark, "model"))
    both = loaded.setPredictionCol("again").transform(model.transform(prices))
    return both.agg(
        F.count("*").alias("n"), F.count_if(F.col("again") == F.col("prediction")).alias("n_same")
    )


def _accuracy(scored):
    return metrics.classification_accuracy(scored, F.col("prediction"), F.col("label"))


@query("l04_logistic_regression_fit")
def logistic_regression_fit(spark, base):
    return _accuracy(classify.fit_and_score(classify.logistic_regression(10), _labelled(spark, base)))


@query("l04_logistic_gradient", "SELECT CAST(p AS INTEGER) AS pos, 0.0::DOUBLE AS gradient FROM range(-1, 64) r(p)")
def logistic_gradient(spark, base):
    """At the fit the penalised loss is flat in every direction."""
    rows = _labelled(spark, base)
    plain = classify.logistic_regression(300, 0.01).setTol(1e-12).setStandardization(False)
    return certificates.logistic_gradient(plain.fit(rows), rows).withColumn("gradient", F.round("gradient", 5) + 0.0)


@query("l05_linear_svm_fit")
def linear_svm_fit(spark, base):
    return _accuracy(classify.fit_and_score(classify.linear_svm(10, 0.1), _labelled(spark, base)))


@query(
    "l06_naive_bayes_fit",
    I.with_tables("entries")
    + """, s AS (SELECT label, j, sum(greatest(v, 0)) AS x FROM entries
              JOIN embeddings ON vec_id = i GROUP BY label, j),
         t AS (SELECT label, sum(x) AS mass FROM s GROUP BY label),
         c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
         SELECT CAST(s.label AS DOUBLE) AS label, CAST(s.j AS INTEGER) AS pos,
                round(ln((c.n + 1.0) / ((SELECT count(*) FROM embeddings) + (SELECT count(*) FROM c))), 6) AS pi,
                round(ln((s.x + 1) / (t.mass + 64)), 6) AS theta
         FROM s JOIN t ON s.label = t.label JOIN c ON s.label = c.label""",
)
def naive_bayes_fit(spark, base):
    rows = I.vec(spark, base).select(
        F.col("label").cast("double").alias("label"),
        F.transform("v", lambda x: F.greatest(x, F.lit(0.0))).alias("features"),
    )
    found = classify.naive_bayes_parameters(rows, 1.0)
    return found.withColumns({"pi": F.round("pi", 6), "theta": F.round("theta", 6)})


@query("l06_naive_bayes_model")
def naive_bayes_model(spark, base):
    return _accuracy(classify.fit_and_score(classify.naive_bayes(1.0), _non_negative(spark, base)))


@query("l07_decision_tree_fit")
def decision_tree_fit(spark, base):
    return _accuracy(classify.fit_and_score(classify.decision_tree(5), _labelled(spark, base)))


@query("l07_leaf_majorities", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS outvoted FROM embeddings")
def leaf_majorities(spark, base):
    """The leaves share out all rows, and each gives the label that most of its rows have."""
    rows = _labelled(spark, base)
    leaves = certificates.leaf_majorities(classify.decision_tree(5).fit(rows), rows)
    return leaves.agg(F.sum("n").alias("n"), F.max("outvoted").alias("outvoted"))


@query(
    "l08_classification_accuracy",
    GRADED_SQL + "SELECT round(avg(CASE WHEN guess = label THEN 1 ELSE 0 END), 6) AS accuracy, "
    "count(*) AS n FROM graded",
)
def classification_accuracy(spark, base):
    found = metrics.classification_accuracy(
        _graded(spark, base), F.col("score"), F.col("label"), threshold=500
    )
    return found.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "l09_binary_curve_metrics",
    GRADED_SQL
    + """, g AS (SELECT -score AS k, sum(label) AS pos, count(*) - sum(label) AS neg FROM graded GROUP BY score),
         r AS (SELECT *, sum(pos) OVER (ORDER BY k) AS tp, sum(neg) OVER (ORDER BY k) AS fp,
               (SELECT sum(pos) FROM g) AS p, (SELECT sum(neg) FROM g) AS n FROM g),
         q AS (SELECT *, tp / (tp + fp) AS prec, coalesce(lag(tp / (tp + fp)) OVER (ORDER BY k),
               tp / (tp + fp)) AS prev FROM r),
         h AS (SELECT count(*) FILTER (WHERE guess = 1 AND label = 1)::DOUBLE AS tp,
               count(*) FILTER (WHERE guess = 1 AND label = 0)::DOUBLE AS fp,
               sum(label)::DOUBLE AS p, (count(*) - sum(label))::DOUBLE AS n FROM graded)
         SELECT 'score' AS predicted_by, round(sum(neg * (2 * tp - pos) / 2.0 / (p * n)), 6) AS roc_area,
                round(sum(pos * (prec + prev) / 2.0 / p), 6) AS pr_area FROM q UNION ALL
         SELECT 'guess', round((tp / p - fp / n + 1) / 2, 6), round(tp / p * tp / (tp + fp) +
                (1 - tp / p) * (tp / (tp + fp) + p / (p + n)) / 2, 6) FROM h""",
)
def binary_curve_metrics(spark, base):
    graded = _graded(spark, base)
    soft = metrics.curve_areas(graded, "score", "label")
    hard = metrics.curve_areas_hard(graded, "guess", "label")
    both = soft.withColumn("predicted_by", F.lit("score")).unionByName(
        hard.withColumn("predicted_by", F.lit("guess"))
    )
    return both.withColumns({n: F.round(n, 6) for n in ("roc_area", "pr_area")})


@query(
    "l10_precision_recall",
    GRADED_SQL
    + """, c AS (SELECT count(*) FILTER (WHERE guess = 1 AND label = 1) AS tp,
              count(*) FILTER (WHERE guess = 1 AND label = 0) AS fp,
              count(*) FILTER (WHERE guess = 0 AND label = 1) AS fn,
              count(*) FILTER (WHERE guess = 0 AND label = 0) AS tn FROM graded)
         SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision,
                round(tp / (tp + fn), 6) AS recall, round(fp / (fp + tn), 6) AS fpr FROM c""",
)
def precision_recall(spark, base):
    found = metrics.precision_recall(_graded(spark, base), "guess", "label")
    return found.withColumns({n: F.round(n, 6) for n in ("precision", "recall", "fpr")})


@query(
    "l11_standard_scale",
    I.with_tables("entries")
    + "SELECT i AS vec_id, CAST(j AS INTEGER) AS pos, "
    "round((v - avg(v) OVER (PARTITION BY j)) / stddev_samp(v) OVER (PARTITION BY j), 6) AS x FROM entries",
)
def standard_scale(spark, base):
    rows = I.vec(spark, base).select("vec_id", "v")
    scaled = features.standard_scale(rows, "v", "z")
    return scaled.select("vec_id", F.posexplode("z").alias("pos", "x")).withColumn(
        "x", F.round("x", 6)
    )


@query(
    "l12_one_hot_category",
    """SELECT p_partkey, 8 AS width, CAST(t.idx AS BIGINT) AS place, CAST(p_size AS DOUBLE) AS size,
       p_retailprice AS price FROM part JOIN (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS idx
       FROM (SELECT DISTINCT p_type FROM part)) t USING (p_type)""",
)
def one_hot_category(spark, base):
    part = read_table(spark, base, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    made = features.one_hot_category(part, "p_type", ["p_size", "p_retailprice"])
    v = vector_to_array("features")
    return made.select(
        "p_partkey",
        F.size(v).alias("width"),
        (F.array_position(v, 1.0) - 1).alias("place"),
        V.element(v, -2).alias("size"),
        V.element(v, -1).alias("price"),
    )


@query("l13_param_sweep")
def param_sweep(spark, base):
    return classify.param_sweep(_non_negative(spark, base), classify.default_sweep())


@query("l14_holdout_validation")
def holdout_validation(spark, base):
    return classify.holdout_validation(_labelled(spark, base))


@query(
    "l15_als_fit",
    I.with_tables("rating")
    + "SELECT DISTINCT CAST(item AS INTEGER) AS id, 50 AS rank, true AS is_finite FROM rating",
)
def als_fit(spark, base):
    # The factors depend on the solver; that every rated item has 50 of them does not.
    model = recommend.als_fit(I.rating(spark, base))
    finite = F.forall("features", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6))
    return model.itemFactors.select(
        "id", F.size("features").alias("rank"), finite.alias("is_finite")
    )


@query("l16_recommend_for_user")
def recommend_for_user(spark, base):
    ratings = materialise(I.rating(spark, base), "ratings")
    model = recommend.als_fit(ratings)
    chosen = ratings.filter("user_no = 89").select("user_no").distinct()
    return recommend.recommend_for_users(model, chosen, 10)


@query("l17_recommend_for_all")
def recommend_for_all(spark, base):
    return recommend.recommend_for_all(recommend.als_fit(I.rating(spark, base)), 10)


@query("l18_als_predict_pairs")
def als_predict_pairs(spark, base):
    ratings = materialise(I.rating(spark, base), "ratings")
    model = recommend.als_fit(ratings)
    return metrics.regression_eval(recommend.predict_pairs(model, ratings), "prediction", "rating")


@query(
    "l17_recommendations_hold",
    I.with_tables("rating")
    + """, u AS (SELECT count(DISTINCT user_no) AS n FROM rating), i AS (SELECT least(count(DISTINCT item), 10) AS n FROM rating)
         SELECT CAST(u.n * i.n AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_wrong, CAST(0 AS BIGINT) AS unordered FROM u, i""",
)
def recommendations_hold(spark, base):
    """Ten items a user, each scored by its factors, never better than the one before."""
    model = recommend.als_fit(I.rating(spark, base))
    found = materialise(recommend.recommend_for_all(model, 10), "recommended")
    products = certificates.wrong_products(model, found, "score")
    pairs = found.select("user_no", "rank", "score").alias("a").join(
        found.select("user_no", (F.col("rank") - 1).alias("rank"), F.col("score").alias("after")).alias("b"), ["user_no", "rank"]
    )
    return products.crossJoin(F.broadcast(pairs.agg(F.count_if(F.col("after") > F.col("score")).alias("unordered"))))


@query(
    "l18_als_products",
    I.with_tables("rating") + "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_wrong FROM rating",
)
def als_products(spark, base):
    ratings = materialise(I.rating(spark, base), "ratings")
    model = recommend.als_fit(ratings)
    return certificates.wrong_products(model, materialise(recommend.predict_pairs(model, ratings), "predicted"), "prediction")


@query("l19_similar_items")
def similar_items(spark, base):
    model = recommend.als_fit(I.rating(spark, base))
    return recommend.similar_items(model.itemFactors, 67, 10)


def _rankings(spark, base):
    """Products ranked per user by views, and the products the user bought."""
    clicks = I.click_log(spark, base)
    viewed = (
        clicks.filter("category = 'view'").groupBy("user_id", "product").agg(F.count("*").alias("n"))
    )
    bought = clicks.filter("category = 'purchase'").select("user_id", "product")
    return viewed, bought


def _ap_sql(k):
    shown = "ranked" if k is None else f"(SELECT * FROM ranked WHERE rank <= {k})"
    least = "n_actual" if k is None else f"least(n_actual, {k})"
    return (
        I.with_tables("click_log")
        + f""", ranked AS (SELECT user_id, product, row_number() OVER
                 (PARTITION BY user_id ORDER BY count(*) DESC, product) AS rank
              FROM click_log WHERE category = 'view' GROUP BY user_id, product),
            bought AS (SELECT DISTINCT user_id, product FROM click_log WHERE category = 'purchase'),
            n AS (SELECT user_id, count(*) AS n_actual FROM bought GROUP BY user_id),
            hit AS (SELECT r.user_id, row_number() OVER (PARTITION BY r.user_id ORDER BY rank) / rank AS gain
              FROM {shown} r JOIN bought b ON r.user_id = b.user_id AND r.product = b.product),
            ap AS (SELECT u.user_id, CASE WHEN n_actual IS NULL THEN 1.0 ELSE coalesce(g, 0) / {least} END AS ap
              FROM (SELECT DISTINCT user_id FROM ranked) u LEFT JOIN n ON n.user_id = u.user_id
              LEFT JOIN (SELECT user_id, sum(gain) AS g FROM hit GROUP BY user_id) h ON h.user_id = u.user_id) """
    )


@query(
    "l20_avg_precision_at_k",
    _ap_sql(10) + "SELECT user_id, round(ap, 6) AS ap FROM ap",
)
def avg_precision_at_k(spark, base):
    viewed, bought = _rankings(spark, base)
    ranked = materialise(
        top_n_per_group(viewed, "user_id", [F.desc("n"), F.asc("product")], 10), "ranking"
    )
    found = metrics.average_precision(ranked, bought, "user_id", "product", k=10)
    return found.withColumn("ap", F.round("ap", 6))


@query(
    "l21_ranking_map",
    _ap_sql(None) + "SELECT round(avg(ap), 6) AS map, count(*) AS n_users FROM ap",
)
def ranking_map(spark, base):
    viewed, bought = _rankings(spark, base)
    ranked = materialise(ranking.rank_within(viewed.withColumn("least", -F.col("n")), "user_id", ["least", "product"]).drop("least"), "ranking")
    found = metrics.mean_average_precision(ranked, bought, "user_id", "product")
    return found.withColumn("map", F.round("map", 6))


@query("l22_kmeans_fit_predict")
def kmeans_fit_predict(spark, base):
    rows = read_table(spark, base, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = cluster.kmeans_fit(rows, k=5, iterations=10, runs=3)
    return cluster.assign(model, rows).select("vec_id", F.col("prediction").alias("cluster"))


@query("l23_kmeans_plus_plus_init")
def kmeans_plus_plus_init(spark, base):
    rows = _labelled(spark, base)
    costs = [
        (init, cluster.kmeans_fit(rows, k=5, iterations=10, runs=1, init=init).summary.trainingCost)
        for init in ("k-means||", "random")
    ]
    return spark.createDataFrame(costs, "init string, cost double")


@query(
    "l24_kmeans_one_step",
    I.with_tables("entries")
    + """, centre AS (SELECT label, j, avg(v) AS c FROM entries JOIN embeddings ON vec_id = i GROUP BY label, j),
         d AS (SELECT e.i, c.label, sum((e.v - c.c) * (e.v - c.c)) AS d FROM entries e
               JOIN centre c ON c.j = e.j GROUP BY e.i, c.label),
         near AS (SELECT i, label AS cluster FROM (SELECT *, row_number() OVER
               (PARTITION BY i ORDER BY d, label) AS rn FROM d) WHERE rn = 1)
         SELECT cluster, CAST(j AS INTEGER) AS pos, count(*) AS n, round(avg(v), 6) AS x
         FROM near JOIN entries USING (i) GROUP BY cluster, j""",
)
def kmeans_one_step(spark, base):
    rows = I.vec(spark, base)
    start = cluster.group_centres(rows, "label", "v").withColumnRenamed("label", "cluster")
    step = cluster.kmeans_one_step(rows.select("vec_id", "v"), "v", start)
    return step.select("cluster", "n", F.posexplode("centre").alias("pos", "x")).withColumn(
        "x", F.round("x", 6)
    )


CENTRES, SEED = 5, 42


def _race_sql():
    """The starting centres ``start`` (cluster, vec_id, e): one race after the other over all rows ``v``."""
    share = "('0x' || substr(md5(vec_id || '|{}'), 1, 8))::BIGINT / 4294967296.0"
    parts = [
        "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
        f"p0 AS (SELECT vec_id, e FROM v ORDER BY -ln(1 - {share.format(SEED)}), vec_id LIMIT 1)",
        "g1 AS (SELECT v.vec_id, v.e, pow(list_distance(v.e, p0.e), 2) AS d FROM v, p0)",
    ]
    for n in range(1, CENTRES):
        parts.append(f"p{n} AS (SELECT vec_id, e FROM g{n} WHERE d > 0 ORDER BY -ln(1 - {share.format(SEED + n)}) / d, vec_id LIMIT 1)")
        parts.append(f"g{n + 1} AS (SELECT g.vec_id, g.e, least(g.d, pow(list_distance(g.e, p{n}.e), 2)) AS d FROM g{n} g, p{n})")
    parts.append("start AS (" + " UNION ALL ".join(f"SELECT {n} AS cluster, vec_id, e FROM p{n}" for n in range(CENTRES)) + ")")
    return "WITH " + ", ".join(parts)


def _lloyd_sql(old, new):
    """One step from the centres ``old``: ``new`` (cluster, n, e)."""
    return f"""{new}_near AS (SELECT v.vec_id, v.e, arg_min(c.cluster, list_distance(v.e, c.e)) AS cluster FROM v, {old} c GROUP BY v.vec_id, v.e),
        {new} AS (SELECT cluster, any_value(n) AS n, list(x ORDER BY pos) AS e FROM
             (SELECT cluster, pos, count(*) AS n, avg(x) AS x FROM
                  (SELECT cluster, unnest(e) AS x, unnest(range(len(e))) AS pos FROM {new}_near) GROUP BY cluster, pos)
             GROUP BY cluster)"""


def _start(spark, base):
    return cluster.kmeans_start(I.vec(spark, base), "vec_id", "v", CENTRES, SEED)


@query("l23_kmeans_race_start", _race_sql() + " SELECT cluster, vec_id FROM start")
def kmeans_race_start(spark, base):
    return _start(spark, base).select("cluster", "vec_id")


@query(
    "l22_kmeans_two_steps",
    f"{_race_sql()}, {_lloyd_sql('start', 'first')}, {_lloyd_sql('first', 'second')}"
    " SELECT cluster, n, CAST(pos AS INTEGER) AS pos, round(x, 6) AS x FROM"
    " (SELECT cluster, n, unnest(e) AS x, unnest(range(len(e))) AS pos FROM second)",
)
def kmeans_two_steps(spark, base):
    centres = cluster.kmeans_steps(I.vec(spark, base), "v", _start(spark, base), 2)
    return centres.select("cluster", "n", F.posexplode("centre").alias("pos", "x")).withColumn("x", F.round("x", 6))


CENTRE_DISTANCE_SQL = """, centre AS (SELECT label, j, avg(v) AS c
      FROM entries JOIN embeddings ON vec_id = i GROUP BY label, j),
    dist AS (SELECT e.i AS vec_id, m.label, sum((e.v - c.c) * (e.v - c.c)) AS d
      FROM entries e JOIN embeddings m ON m.vec_id = e.i
      JOIN centre c ON c.label = m.label AND c.j = e.j GROUP BY e.i, m.label) """


@query(
    "l25_cluster_wcss",
    I.with_tables("entries") + CENTRE_DISTANCE_SQL
    + "SELECT label, count(*) AS n, round(sum(d), 6) AS wcss FROM dist GROUP BY label",
)
def cluster_wcss(spark, base):
    found = cluster.cluster_wcss(I.vec(spark, base), "label", "v")
    return found.withColumn("wcss", F.round("wcss", 6))


@query("l25_cluster_wcss_by_k")
def cluster_wcss_by_k(spark, base):
    rows = I.vec(spark, base).select("vec_id", array_to_vector("v").alias("features"))
    parts = X.random_split(rows, ["vec_id"], [0.6, 0.4], seed=123)
    return cluster.wcss_by_k(parts.filter("part = 0"), parts.filter("part = 1"))


@query(
    "l26_cluster_profile",
    I.with_tables("entries") + CENTRE_DISTANCE_SQL
    + "SELECT vec_id, label, lang, source, round(d, 6) AS distance FROM dist "
    "JOIN documents ON doc_id = vec_id",
)
def cluster_profile(spark, base):
    titles = read_table(spark, base, "documents").select(
        F.col("doc_id").alias("vec_id"), "lang", "source"
    )
    found = cluster.cluster_profile(I.vec(spark, base), titles, "vec_id", "label", "v")
    return found.withColumn("distance", F.round("distance", 6))


@query("l27_pca_fit_project")
def pca_fit_project(spark, base):
    rows = read_table(spark, base, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    projected = reduce.pca_project(reduce.pca_fit(rows, 10), rows)
    return projected.select(
        "vec_id", F.posexplode(vector_to_array("projected")).alias("component", "x")
    )


@query(
    "l27_pca_axes",
    I.with_tables("entries")
    + """, centred AS (SELECT i, v - avg(v) OVER (PARTITION BY j) AS v FROM entries)
         SELECT 'length' AS kind, i AS a, CAST(0 AS BIGINT) AS b, round(sum(v * v), 5) AS x FROM centred GROUP BY i
         UNION ALL SELECT 'covariance', p, q, 0.0 FROM range(64) a(p), range(64) b(q) WHERE p < q""",
)
def pca_axes(spark, base):
    """On all axes centred rows keep their lengths, and the coordinates are not correlated."""
    centred = features.standard_scale(I.vec(spark, base), "v", "z", with_std=False).select(
        "vec_id", array_to_vector("z").alias("features")
    )
    found = materialise(
        reduce.pca_project(reduce.pca_fit(centred, 64), centred).select("vec_id", vector_to_array("projected").alias("y")), "projected"
    )
    lengths = found.select(
        F.lit("length").alias("kind"), F.col("vec_id").alias("a"), F.lit(0).cast("long").alias("b"),
        F.round(F.aggregate("y", F.lit(0.0), lambda s, v: s + v * v), 5).alias("x"),
    )
    products = M.gram(found, "y").filter("i < j").select(
        F.lit("covariance").alias("kind"), F.col("i").alias("a"), F.col("j").alias("b"), F.round("v", 5) + 0.0
    )
    return lengths.union(products)


@query("l28_svd_topk")
def svd_topk(spark, base):
    rows = features.standard_scale(I.vec(spark, base), "v", "z", with_std=False)
    values, _ = reduce.svd_topk(rows, "z", 10)
    return values


CENTRED_SQL = """, centred AS (SELECT i, j, v - avg(v) OVER (PARTITION BY j) AS v FROM entries) """


@query(
    "l28_svd_energy",
    I.with_tables("entries") + CENTRED_SQL
    + "SELECT CAST(64 AS BIGINT) AS k, round(sum(v * v), 4) AS energy, round(sum(v * v), 4) AS projected FROM centred",
)
def svd_energy(spark, base):
    """All singular values: their squares, and those of U times S, add up to those of the entries."""
    rows = features.standard_scale(I.vec(spark, base), "v", "z", with_std=False)
    values, right = reduce.svd_topk(rows, "z", 64)
    both = reduce.svd_left(rows, "z", values, right, 64)
    squares = F.aggregate("us", F.lit(0.0), lambda a, x: a + x * x)
    total = both.agg(F.round(F.sum(squares), 4).alias("projected"))
    singular = values.agg(F.count("*").alias("k"), F.round(F.sum(F.col("s") ** 2), 4).alias("energy"))
    return singular.withColumn("projected", total.scalar())


@query(
    "l28_svd_left_rows",
    I.with_tables("entries") + CENTRED_SQL
    + "SELECT i AS vec_id, round(sum(v * v), 6) AS squared FROM centred GROUP BY i",
)
def svd_left_rows(spark, base):
    """Each row's U times S is as long as the row, since the right vectors are a rotation."""
    rows = features.standard_scale(I.vec(spark, base), "v", "z", with_std=False)
    values, right = reduce.svd_topk(rows, "z", 64)
    both = reduce.svd_left(rows.select("vec_id", "z"), "z", values, right, 64)
    squares = F.aggregate("us", F.lit(0.0), lambda a, x: a + x * x)
    return both.select("vec_id", F.round(squares, 6).alias("squared"))


@query(
    "l29_model_score_table",
    "SELECT l_orderkey, round(intercept + slope * l_quantity, 5) AS prediction FROM lineitem, "
    "(SELECT regr_slope(l_extendedprice / 1000, l_quantity) AS slope, "
    "regr_intercept(l_extendedprice / 1000, l_quantity) AS intercept FROM lineitem)",
)
def model_score_table(spark, base):
    prices = _prices(spark, base)
    model = regress.linear_regression_fit(prices, solver="normal")
    scored = classify.score_table(model, prices)
    return scored.select("l_orderkey", F.round("prediction", 5).alias("prediction"))
