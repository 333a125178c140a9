"""Classification: fits, scoring, parameter sweeps."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml.parallel import run_all


def logistic_regression(iterations: int = 10, reg: float = 0.0) -> LogisticRegression:
    """Logistic regression with an L2 penalty."""
    return LogisticRegression(maxIter=iterations, regParam=reg, elasticNetParam=0.0)


def linear_svm(iterations: int = 10, reg: float = 0.1) -> LinearSVC:
    """Linear support vector machine."""
    return LinearSVC(maxIter=iterations, regParam=reg)


def naive_bayes(smoothing: float = 1.0, kind: str = "multinomial") -> NaiveBayes:
    """Naive Bayes over non-negative features."""
    return NaiveBayes(smoothing=smoothing, modelType=kind)


def decision_tree(depth: int = 5, impurity: str = "entropy") -> DecisionTreeClassifier:
    """A classification tree."""
    return DecisionTreeClassifier(maxDepth=depth, impurity=impurity, seed=42)


def fit_and_score(estimator: Estimator, train: DataFrame, test: DataFrame | None = None) -> DataFrame:
    """Fit on one table and add predictions to another (by default the same)."""
    return score_table(estimator.fit(train), train if test is None else test)


def score_table(model: Model, df: DataFrame) -> DataFrame:
    """Predictions of a fitted model for a table or a stream."""
    return model.transform(df)


def naive_bayes_parameters(df: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """Multinomial naive Bayes parameters from counts: ``(label, pos, pi, theta)``.

    ``df`` has ``label`` and an array ``features``.  One vector sum per label and task
    is shuffled.
    """
    sums = df.groupBy("label").agg(
        F.count("*").alias("n"),
        vector_to_array(
            Summarizer.sum(array_to_vector(F.col("features").cast("array<double>")))
        ).alias("s"),
    )
    totals = sums.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("labels"))).scalar()
    mass = F.aggregate("s", F.lit(0.0), lambda a, x: a + x) + F.size("s") * F.lit(smoothing)
    prior = F.log(
        (F.col("n") + smoothing) / (F.col("t.rows") + F.col("t.labels") * F.lit(smoothing))
    )
    return (
        sums.withColumn("t", totals)
        .withColumn("pi", prior)
        .withColumn("mass", mass)
        .select("label", "pi", "mass", F.posexplode("s").alias("pos", "x"))
        .select("label", "pos", "pi", F.log((F.col("x") + smoothing) / F.col("mass")).alias("theta"))
    )


def area_under_roc(scored: DataFrame, hard: bool = True) -> float:
    """Area under ROC of 0/1 predictions, or of raw scores."""
    column = "prediction" if hard else "rawPrediction"
    return BinaryClassificationEvaluator(rawPredictionCol=column).evaluate(scored)


def param_sweep(
    train: DataFrame, estimators: Sequence[tuple[str, float, Estimator]], parallelism: int = 4
) -> DataFrame:
    """Area under ROC on the training rows for each ``(parameter, value, estimator)``.

    The fits share the cached training rows; the result has one row per fit.
    """
    held = train.persist()
    try:
        areas = run_all(
            train.sparkSession,
            [lambda e=estimator: area_under_roc(fit_and_score(e, held)) for *_, estimator in estimators],
            parallelism,
        )
    finally:
        held.unpersist()
    rows = [(name, float(value), area) for (name, value, _), area in zip(estimators, areas)]
    return train.sparkSession.createDataFrame(rows, "parameter string, value double, auc double")


def default_sweep() -> list[tuple[str, float, Estimator]]:
    """Iterations, L2 strength, tree depth and smoothing, one at a time."""
    # The parameter grids.
    iterations = (1, 5, 10, 50)
    l2 = (0.001, 0.01, 0.1, 1.0, 10.0)
    depths = (1, 2, 3, 4, 5, 10, 20)
    smoothing = (0.001, 0.01, 0.1, 1.0, 10.0)
    return [
        *[("iterations", i, logistic_regression(i)) for i in iterations],
        *[("l2", r, logistic_regression(10, r)) for r in l2],
        *[("depth", d, decision_tree(d, "gini")) for d in depths],
        *[("smoothing", s, naive_bayes(s)) for s in smoothing],
    ]


# The strengths that a held-out part chooses from.
HOLDOUT_STRENGTHS = (0.0, 0.001, 0.0025, 0.005, 0.01)


def holdout_validation(
    df: DataFrame,
    regs: Sequence[float] = HOLDOUT_STRENGTHS,
    train_ratio: float = 0.6,
    seed: int = 123,
    parallelism: int = 4,
) -> DataFrame:
    """Area under ROC on the held-out part for each L2 strength, best first."""
    estimator = logistic_regression()
    grid = ParamGridBuilder().addGrid(estimator.regParam, list(regs)).build()
    split = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(),
        trainRatio=train_ratio,
        seed=seed,
        parallelism=parallelism,
    )
    metrics = split.fit(df).validationMetrics
    rows = [(float(r), float(m)) for r, m in zip(regs, metrics) if not math.isnan(m)]
    result = df.sparkSession.createDataFrame(rows, "reg double, auc double")
    return result.orderBy(F.desc("auc"), "reg")
