"""Staff reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def department_stats(employee: DataFrame, department: DataFrame, older_than: int = 20) -> DataFrame:
    """Mean salary and age by department and gender of staff above an age."""
    older = employee.filter(F.col("age") > older_than)
    return (
        older.join(department, older.dep_id == department.id)
        .groupBy("dep_name", "gender")
        .agg(F.avg("salary").alias("mean_salary"), F.avg("age").alias("mean_age"))
    )


def good_students(infos: DataFrame, scores: DataFrame, least: float) -> DataFrame:
    """Infos and scores of those who scored at least so much; both have ``name``."""
    return infos.join(scores.filter(F.col("score") >= least), "name")
