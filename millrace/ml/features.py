"""Feature columns for the model pipelines."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import distinct_index
from millrace.session import materialise


def labelled(df: DataFrame, label: Column, vector: Column) -> DataFrame:
    """Columns ``label`` (double) and ``features`` (ML vector) from an array column."""
    return df.select(
        label.cast("double").alias("label"),
        array_to_vector(vector.cast("array<double>")).alias("features"),
    )


def standard_scale(
    df: DataFrame,
    features: str,
    into: str,
    with_mean: bool = True,
    with_std: bool = True,
) -> DataFrame:
    """Subtract the column means and divide by the sample deviations, each optional.

    ``features`` is an array column, and so is the result.
    """
    rows = df.withColumn("_features", array_to_vector(F.col(features).cast("array<double>")))
    scaler = StandardScaler(
        inputCol="_features", outputCol="_scaled", withMean=with_mean, withStd=with_std
    )
    scaled = scaler.fit(rows).transform(rows)
    return scaled.withColumn(into, vector_to_array("_scaled")).drop("_features", "_scaled")


def one_hot_category(
    df: DataFrame, category: str, numbers: list[str], into: str = "features"
) -> DataFrame:
    """A category as a 1-of-k vector (categories in value order) followed by numbers.

    The vector stays sparse, so a wide category costs one stored value per row.  The
    index of the categories is a table that is joined; a null category stores no value.
    """
    names = materialise(distinct_index(df.filter(F.col(category).isNotNull()), category, "_index"), "categories")
    k = names.count()
    indexed = df.join(names, category, "left").withColumn(
        "_index", F.coalesce(F.col("_index"), F.lit(k)).cast("double")
    )
    # One place more than there are categories, for nulls, which the encoder then drops.
    widest = df.sparkSession.createDataFrame([(float(k),)], "_index double")
    encoder = OneHotEncoder(inputCol="_index", outputCol="_one_hot", dropLast=True).fit(widest)
    assembler = VectorAssembler(inputCols=["_one_hot", *numbers], outputCol=into)
    return assembler.transform(encoder.transform(indexed)).select(*df.columns, into)
