"""Key figures of a news site from its access log.

The log has ``date``, ``user_id`` (null for anonymous visits), ``page_id``, ``section``
and ``action`` (``view``, ``register``, ...).  Every report covers all days of the log, or
one day when a date is given; the date then reaches the scan as a filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators.topn import top_n_per_group


def _views(log: DataFrame, date: str | None) -> DataFrame:
    return _day(log, date).filter(F.col("action") == "view")


def _day(log: DataFrame, date: str | None) -> DataFrame:
    return log if date is None else log.filter(F.col("date") == F.to_date(F.lit(date)))


def daily_page_pv(log: DataFrame, date: str | None = None) -> DataFrame:
    """Views per day and page, most viewed first."""
    views = _views(log, date).groupBy("date", "page_id").agg(F.count("*").alias("pv"))
    return views.orderBy(F.desc("pv"), "date", "page_id")


def daily_page_uv(log: DataFrame, date: str | None = None, count_null: bool = True) -> DataFrame:
    """Distinct visitors per day and page; all anonymous visits together count as one."""
    visitors = A.distinct_by_double_group(
        _views(log, date), ["date", "page_id"], "user_id", count_null
    )
    return visitors.withColumnRenamed("n_distinct", "uv").orderBy(F.desc("uv"), "date", "page_id")


def register_rate(
    log: DataFrame, date: str | None = None, register: str = "register"
) -> DataFrame:
    """Registrations (actions named ``register``) per anonymous view, by day; null without anonymous views."""
    rates = A.ratio_of_counts(
        _day(log, date),
        ["date"],
        F.col("action") == register,
        (F.col("action") == "view") & F.col("user_id").isNull(),
    )
    return rates.select(
        "date",
        F.col("numerator").alias("registrations"),
        F.col("denominator").alias("anonymous_views"),
        "rate",
    )


def jump_rate(log: DataFrame, date: str | None = None) -> DataFrame:
    """Known users with exactly one view per view by known users, by day."""
    per_user = (
        _views(log, date)
        .filter(F.col("user_id").isNotNull())
        .groupBy("date", "user_id")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_user.groupBy("date")
        .agg(F.count_if(F.col("n") == 1).alias("jumps"), F.sum("n").alias("views"))
        .withColumn("rate", F.round(F.try_divide("jumps", "views"), 2))
    )


def section_pv_rank(log: DataFrame, date: str | None = None) -> DataFrame:
    """Views per day and section, most viewed first."""
    views = _views(log, date).groupBy("date", "section").agg(F.count("*").alias("pv"))
    return views.orderBy(F.desc("pv"), "date", "section")


def daily_uv(log: DataFrame) -> DataFrame:
    """Distinct known users per day."""
    return log.groupBy("date").agg(F.countDistinct("user_id").alias("uv"))


def daily_top_keywords(searches: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` keywords searched by most users, per day; ``searches`` has date, word, user_id."""
    users = searches.groupBy("date", "word").agg(F.countDistinct("user_id").alias("n_users"))
    return top_n_per_group(users, "date", [F.desc("n_users"), F.asc("word")], n)
