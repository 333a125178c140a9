"""Linear models updated on every micro-batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import vectors as V
from millrace.streaming.sinks import start

Weights = dict[str, list[float]]


# Feature vectors up to this width are written out element by element, which stays in
# generated code: twenty times faster than the array form at width 3.
WRITTEN_OUT = 64


def predict(features: Column, weights: Sequence[float]) -> Column:
    """The linear model's value for a feature array."""
    if len(weights) > WRITTEN_OUT:
        return V.dot(features, F.array(*[F.lit(float(w)) for w in weights]))
    return reduce(add, [F.get(features, F.lit(i)) * float(w) for i, w in enumerate(weights)])


def mean_gradient(features: Column, error: Column, width: int) -> Column:
    """The mean of error times features over all rows, as an array."""
    if width > WRITTEN_OUT:
        scaled = F.transform(features, lambda x: x * error)
        return vector_to_array(Summarizer.mean(array_to_vector(scaled)))
    return F.array(*[F.avg(error * F.get(features, F.lit(i))) for i in range(width)])


class OnlineLinearModels:
    """Least-squares models that differ in step size, trained by gradient descent.

    A batch's gradients are one aggregate over the batch for all models together; only
    that row of ``models x width`` numbers reaches the driver.  The weights before
    batch N are stored under ``path/weights/version=N``, so a repeated batch starts from
    the same weights.
    """

    def __init__(
        self,
        path: str,
        steps: Mapping[str, float],
        width: int,
        iterations: int = 1,
        start: Sequence[float] | None = None,
    ) -> None:
        self.path = path
        self.steps = dict(steps)
        self.iterations = iterations
        self.start = [float(w) for w in (start if start is not None else [0.0] * width)]

    def weights(self, spark: SparkSession, version: int) -> Weights:
        """The weights of every model before batch ``version``."""
        if version == 0:
            return {m: list(self.start) for m in self.steps}
        stored = spark.read.parquet(f"{self.path}/weights/version={version}")
        return {r["model"]: list(r["weights"]) for r in stored.collect()}

    def _store(self, spark: SparkSession, version: int, weights: Weights) -> None:
        rows = spark.createDataFrame(
            list(weights.items()), "model string, weights array<double>"
        )
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/weights/version={version}")

    def _descend(self, batch: DataFrame, weights: Weights) -> tuple[Weights, dict[str, float]]:
        """The weights after the batch, and each model's mean squared error before it.

        Rows without a label, without features or with a missing one are not learned from.
        """
        whole = F.col("features").isNotNull() & F.forall("features", lambda x: x.isNotNull())
        batch = batch.filter(F.col("label").isNotNull() & whole)
        errors: dict[str, float] = {}
        for i in range(1, self.iterations + 1):
            measures = []
            for model, w in weights.items():
                error = predict(F.col("features"), w) - F.col("label")
                measures += [
                    mean_gradient(F.col("features"), error, len(w)).alias(model),
                    F.avg(error * error).alias(f"_mse_{model}"),
                ]
            row = batch.agg(F.count("*").alias("_n"), *measures).first()
            if row["_n"] == 0:
                break
            errors = errors or {m: row[f"_mse_{m}"] for m in weights}
            weights = {
                m: [w - self.steps[m] / i**0.5 * g for w, g in zip(weights[m], row[m])]
                for m in weights
            }
        return weights, errors

    def train_on(
        self, stream: DataFrame, keep: Sequence[str] = (), trigger: dict | None = None
    ) -> StreamingQuery:
        """Train on a stream of ``label`` and ``features`` (array of doubles).

        Every batch writes two results.  ``path/errors/batch=N``: the mean squared error
        of each model before it learns from the batch.  ``path/predictions/batch=N``: the
        kept columns and the prediction of each model after it did.
        """

        def run(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            rows = batch.select(*keep, "label", "features")
            if self.iterations > 1:
                rows = rows.persist()
            try:
                after, errors = self._descend(rows, self.weights(spark, batch_id))
                if not errors:
                    self._store(spark, batch_id + 1, after)
                    return
                spark.createDataFrame(
                    [(m, e, e**0.5) for m, e in errors.items()],
                    "model string, mse double, rmse double",
                ).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/errors/batch={batch_id}")
                rows.select(
                    *keep, *[predict(F.col("features"), w).alias(m) for m, w in after.items()]
                ).write.mode("overwrite").parquet(f"{self.path}/predictions/batch={batch_id}")
                self._store(spark, batch_id + 1, after)
            finally:
                if self.iterations > 1:
                    rows.unpersist()

        return start(
            stream, f"{self.path}/query", "append", trigger, lambda writer: writer.foreachBatch(run)
        )

    def results(self, spark: SparkSession, kind: str) -> DataFrame:
        """All batches of ``errors`` or ``predictions``, with their number in ``batch``."""
        path = f"{self.path}/{kind}"
        return spark.read.option("basePath", path).parquet(path)
