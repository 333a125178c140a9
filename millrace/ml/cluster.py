"""Clustering: k-means, its single step, costs and profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.functions.folding import stacked
from millrace.ml import shards
from millrace.ml.parallel import run_all
from millrace.operators.sampling import hash_share
from millrace.operators.topn import top_n_per_group
from millrace.session import materialise


def kmeans_fit(
    df: DataFrame,
    k: int = 5,
    iterations: int = 10,
    runs: int = 3,
    seed: int = 42,
    features: str = "features",
    init: str = "k-means||",
) -> KMeansModel:
    """K-means from several seeds; the model with the least training cost wins.

    ``k-means||`` picks starting centres with a probability that grows with their
    distance from those already picked; ``random`` picks any rows.
    """
    models = [
        KMeans(
            k=k, maxIter=iterations, seed=seed + run, initMode=init, featuresCol=features
        ).fit(df)
        for run in range(runs)
    ]
    return min(models, key=lambda m: m.summary.trainingCost)


def assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """The cluster of every row, in column ``prediction``."""
    return model.transform(df)


def centre_table(model: KMeansModel, df: DataFrame) -> DataFrame:
    """The centres of a fitted model as ``(cluster, centre)``."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster int, centre array<double>")


def group_centres(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """The mean vector of each cluster; one running sum per cluster and task is shuffled."""
    mean = Summarizer.mean(array_to_vector(V.dense(F.col(vector))))
    return df.groupBy(cluster).agg(vector_to_array(mean).alias("centre"))


def _nearest_of(points: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the place of the nearest point, of equally near ones the first, and the squared distance."""
    best = np.full(len(x), np.inf)
    place = np.zeros(len(x), dtype=int)
    for i, point in enumerate(points):
        d = ((x - point) ** 2).sum(axis=1)
        place[d < best] = i
        best = np.minimum(best, d)
    return place, best


def _nearest_in(ids: np.ndarray, points: np.ndarray, kind: str):
    """An Arrow function to the nearest of some centres, sorted by id; null for a missing vector."""

    @F.pandas_udf(f"distance double, cluster {kind}")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place, best = _nearest_of(points, stacked(batch, points.shape[1]))
            found = pd.DataFrame({"distance": best, "cluster": ids[place]})
            missing = batch.isna().to_numpy()
            if missing.any():
                found = found.astype(object)
                found.loc[missing] = None
            yield found

    return nearest


def nearest_centre(df: DataFrame, vector: str, centres: DataFrame) -> DataFrame:
    """Add the nearest centre (``cluster``) and its squared distance to every row.

    ``centres`` has ``cluster`` and ``centre``.  Up to ``shards.SHIPPED_ROWS`` of them go to every
    task and rows are not shuffled; more are dealt to shards, past which the rows' vectors
    stream, and each row's nearest ones are merged.  Equally near centres: the smaller
    cluster wins.  A missing vector and an empty table of centres give neither cluster nor distance.
    """
    kind = centres.schema["cluster"].dataType.simpleString()
    few = shards.small_table(centres.select("cluster", "centre"))
    if few is None:
        return _nearest_in_shards(df, vector, centres, kind)
    held = sorted(few, key=lambda c: c["cluster"])
    best = F.lit(None).cast(f"struct<distance:double,cluster:{kind}>")
    if held:
        ids, points = np.array([c["cluster"] for c in held]), np.array([c["centre"] for c in held])
        best = _nearest_in(ids, points, kind)(V.dense(F.col(vector)))
    measured = df.withColumn("_best", best)
    return measured.withColumns(
        {"cluster": F.col("_best.cluster"), "distance": F.col("_best.distance")}
    ).drop("_best")


def _nearest_in_shards(df: DataFrame, vector: str, centres: DataFrame, kind: str) -> DataFrame:
    """Rows get a number when they are written, by which the nearest centres of all shards meet again."""
    numbered = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    rows = numbered.filter(F.col(vector).isNotNull()).select(F.col("_row").alias("id"), V.dense(F.col(vector)).alias("vector"))
    held = centres.select(F.col("cluster").alias("key"), V.dense(F.col("centre")).alias("vector"))

    def measure(keys, matrix, ids, x):
        if measure.held is None or measure.held[0] is not matrix:
            order = pa.compute.sort_indices(keys)  # equally near: the smaller one
            measure.held = matrix, keys.take(order), matrix[order.to_numpy()]
        _, names, points = measure.held
        place, best = _nearest_of(points, x)
        return pa.RecordBatch.from_arrays([ids, pa.array(best), names.take(pa.array(place))], ["_row", "distance", "cluster"])

    measure.held = None
    found = shards.past_shards(rows, materialise(held, "centres"), measure, f"_row long, distance double, cluster {kind}")
    least = found.groupBy("_row").agg(F.min(F.struct("distance", "cluster")).alias("_best"))
    return numbered.join(least, "_row", "left").select(
        *(F.col(f"`{c}`") for c in df.columns), F.col("_best.cluster").alias("cluster"), F.col("_best.distance").alias("distance")
    )


def kmeans_one_step(df: DataFrame, vector: str, centres: DataFrame) -> DataFrame:
    """Assign every row to its nearest centre, then average per cluster: ``(cluster, n, centre)``."""
    assigned = nearest_centre(df, vector, centres)
    mean = Summarizer.mean(array_to_vector(V.dense(F.col(vector))))
    return assigned.groupBy("cluster").agg(
        F.count("*").alias("n"), vector_to_array(mean).alias("centre")
    )


def kmeans_start(df: DataFrame, row_id: str, vector: str, k: int, seed: int = 42) -> DataFrame:
    """Starting centres ``(cluster, row_id, centre)`` drawn one after the other, far rows more likely.

    The draw of k-means++ as a race: a row at squared distance d from the nearest centre so far
    runs for -ln(u) / d, and the first one home is the next centre, which happens with
    probability d over the sum of all d.  u follows from a hash of the row's id, the seed
    and the number of the draw, so the centres do not depend on the layout of the
    data.  One row a draw reaches the driver.  Rows without id or vector take no part; with
    fewer than k different vectors there are fewer centres.
    """
    rows = df.filter(F.col(row_id).isNotNull() & F.col(vector).isNotNull()).select(F.col(row_id), V.dense(F.col(vector)).alias("centre"))
    drawn: list = []
    for draw in range(k):
        run = -F.log(1 - hash_share([row_id], seed + draw))  # u in (0, 1]
        if drawn:
            gaps = [V.squared_distance(F.col("centre"), F.array(*map(F.lit, d["centre"]))) for d in drawn]
            gap = gaps[0] if len(gaps) == 1 else F.least(*gaps)
            raced = rows.withColumn("_gap", gap).filter(F.col("_gap") > 0).withColumn("_time", run / F.col("_gap"))
        else:
            raced = rows.withColumn("_time", run)
        first = raced.agg(F.min_by(F.struct(row_id, "centre"), F.struct("_time", row_id)).alias("first")).first()["first"]
        if first is None:
            break
        drawn.append(first)
    kind = df.schema[row_id].dataType.simpleString()
    found = [(n, d[row_id], [float(x) for x in d["centre"]]) for n, d in enumerate(drawn)]
    return df.sparkSession.createDataFrame(found, f"cluster int, {row_id} {kind}, centre array<double>")


def kmeans_steps(df: DataFrame, vector: str, centres: DataFrame, steps: int) -> DataFrame:
    """``steps`` times nearest centre and mean, from the given centres: ``(cluster, n, centre)``.

    The centres are written after each step.  One that no row is nearest to stays where it is, with n = 0.
    """
    rows = materialise(df.select(V.dense(F.col(vector)).alias("_v")), "vectors")
    centres = centres.select("cluster", F.lit(0).cast("long").alias("n"), "centre")
    for _ in range(steps):
        moved = kmeans_one_step(rows, "_v", centres).filter("cluster is not null")
        both = centres.select("cluster", F.col("centre").alias("_old")).join(moved, "cluster", "left")
        centres = materialise(
            both.select("cluster", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("centre", "_old").alias("centre")), "centres"
        )
    return centres


def distance_to_centre(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """Add each row's squared distance to the mean of its cluster."""
    # Written once, so that the optimiser knows the size and may ship the centres.
    joined = df.join(materialise(group_centres(df, cluster, vector), "centres"), cluster)
    return joined.withColumn(
        "distance", V.squared_distance(V.dense(F.col(vector)), F.col("centre"))
    ).drop("centre")


def cluster_wcss(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """Within-cluster sum of squared distances, per cluster."""
    return distance_to_centre(df, cluster, vector).groupBy(cluster).agg(
        F.count("*").alias("n"), F.sum("distance").alias("wcss")
    )


def wcss_by_k(
    train: DataFrame,
    test: DataFrame,
    ks: Sequence[int] = (2, 3, 4, 5, 10, 20),
    iterations: int = 10,
    runs: int = 3,
    features: str = "features",
) -> DataFrame:
    """Cost of held-out rows for each number of clusters: ``(k, wcss)``."""
    held = train.persist()
    try:
        models = run_all(
            train.sparkSession,
            [lambda k=k: kmeans_fit(held, k, iterations, runs, features=features) for k in ks],
        )
    finally:
        held.unpersist()
    rows = test.select(vector_to_array(features).alias("_v"))
    measured = rows
    for k, model in zip(ks, models):  # one pass over the rows for all models
        near = nearest_centre(measured, "_v", centre_table(model, test))
        measured = near.withColumnRenamed("distance", f"_d{k}").drop("cluster")
    sums = measured.agg(*(F.sum(f"_d{k}").alias(f"_d{k}") for k in ks))
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"_d{k}").alias("wcss")) for k in ks))
    return sums.select(F.explode(pairs).alias("p")).select("p.k", "p.wcss")


def members_near_centre(
    df: DataFrame, row_id: str, cluster: str, vector: str, n: int
) -> DataFrame:
    """The ``n`` members of each cluster closest to its mean, ranked."""
    measured = distance_to_centre(df, cluster, vector).select(row_id, cluster, "distance")
    return top_n_per_group(measured, cluster, [F.asc("distance"), F.asc(row_id)], n)


def cluster_profile(
    df: DataFrame, titles: DataFrame, row_id: str, cluster: str, vector: str
) -> DataFrame:
    """Every member with its descriptive columns and its distance to the cluster's mean."""
    measured = distance_to_centre(df, cluster, vector).select(row_id, cluster, "distance")
    return measured.join(titles, row_id)
