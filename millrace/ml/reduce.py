"""Dimension reduction."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.matrices import multiply_rows


def pca_fit(df: DataFrame, k: int = 10, features: str = "features") -> PCAModel:
    """The ``k`` directions of largest variance."""
    return PCA(k=k, inputCol=features, outputCol="projected").fit(df)


def pca_project(model: PCAModel, df: DataFrame) -> DataFrame:
    """Rows in the coordinates of the principal components, in column ``projected``."""
    return model.transform(df)


def components_table(model: PCAModel, spark: SparkSession) -> DataFrame:
    """Principal components as ``(i, j, v)``: feature, component, weight."""
    weights = model.pc.toArray()
    rows = [
        (i, j, float(weights[i, j]))
        for i in range(weights.shape[0])
        for j in range(weights.shape[1])
    ]
    return spark.createDataFrame(rows, "i long, j long, v double")


def svd_topk(df: DataFrame, vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The ``k`` largest singular values ``(j, s)`` and right vectors ``(i, j, v)``.

    The decomposition is distributed over the rows; only width x ``k`` numbers are
    gathered.  ``vector`` is an array column; centre it first to get the principal
    components as right vectors.
    """
    vectors = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    svd = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeSVD(k)
    spark = df.sparkSession
    values = spark.createDataFrame(
        [(j, float(s)) for j, s in enumerate(svd.s)], "j long, s double"
    )
    v = svd.V.toArray()
    right = spark.createDataFrame(
        [(i, j, float(v[i, j])) for i in range(v.shape[0]) for j in range(v.shape[1])],
        "i long, j long, v double",
    )
    return values, right


def svd_left(
    df: DataFrame, vector: str, values: DataFrame, right: DataFrame, width: int
) -> DataFrame:
    """Adds ``us``, each row's part of U times S, and ``u``, its part of U.

    U times S is the rows times the right vectors, so it is made row by row; u is null
    where a singular value is 0.
    """
    singular = [r["s"] for r in values.orderBy("j").collect()]
    projected = multiply_rows(df, vector, right, "us", (width, len(singular)))
    u = F.transform("us", lambda x, j: F.try_divide(x, F.nullif(F.get(F.array(*map(F.lit, singular)), j), F.lit(0.0))))
    return projected.withColumn("u", u)
