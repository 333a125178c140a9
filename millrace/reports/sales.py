"""Sales reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.topn import top_n_per_group


def top_products(sales: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` products with most revenue per category; equal revenue in product order."""
    return top_n_per_group(sales, "category", [F.desc("revenue"), F.asc("product")], n)


def batch_metrics(purchases: DataFrame) -> DataFrame:
    """One row for a batch of purchases (user_id, product, price).

    Number, distinct users, revenue and the product bought most.  An empty batch gives
    no row.
    """
    pairs = purchases.groupBy("product", "user_id").agg(F.count("*").alias("n"), F.sum("price").alias("revenue"))
    return _metrics(pairs)


def _metrics(pairs: DataFrame) -> DataFrame:
    """Totals from rows (product, user_id, n, revenue): by product, by user and over all."""
    cubed = pairs.groupingSets([["product"], ["user_id"], []], "product", "user_id").agg(
        F.sum("n").alias("n"), F.sum("revenue").alias("revenue"), F.grouping_id().alias("level")
    )
    whole, per_product, per_user = (F.col("level") == x for x in (3, 1, 2))
    best = F.max(F.when(per_product, F.struct("n", (-F.col("product")).alias("least"))))
    return (
        cubed.agg(
            F.sum(F.when(whole, F.col("n"))).alias("purchases"),
            F.count_if(per_user & F.col("user_id").isNotNull()).alias("users"),
            F.sum(F.when(whole, F.col("revenue"))).alias("revenue"),
            best.alias("_best"),
        )
        .filter("purchases > 0")
        .select(
            "purchases",
            "users",
            "revenue",
            (-F.col("_best.least")).alias("top_product"),
            F.col("_best.n").alias("top_purchases"),
        )
    )
