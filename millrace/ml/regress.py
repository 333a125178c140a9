"""Linear regression."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame


def linear_regression_fit(
    df: DataFrame,
    iterations: int = 100,
    reg: float = 0.0,
    solver: str = "auto",
    features: str = "features",
    label: str = "label",
) -> LinearRegressionModel:
    """Least squares.

    With up to 4096 features the normal equations are summed in one pass over the
    data; beyond that each iteration is one pass.
    """
    return LinearRegression(
        featuresCol=features, labelCol=label, maxIter=iterations, regParam=reg, solver=solver
    ).fit(df)


def save_and_load(model: LinearRegressionModel, path: str) -> LinearRegressionModel:
    """Persist a model and read it back."""
    model.write().overwrite().save(path)
    return type(model).load(path)
