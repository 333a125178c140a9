"""Click-stream reports over event-time windows; inputs may be streams or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.streaming.windows import join_static, sliding_count, top_per_window


def search_word_counts(searches: DataFrame, time: str = "ts") -> DataFrame:
    """Searches per word over the last 60 seconds, every 10 seconds."""
    return sliding_count(searches, time, "word")


def hot_words(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` words searched most in each window."""
    return top_per_window(counts, "n", "word", n)


def product_click_counts(clicks: DataFrame, time: str = "ts") -> DataFrame:
    """Clicks per category and product over the last 60 seconds, every 10 seconds."""
    return sliding_count(clicks, time, "category", "product")


def hot_products(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` products clicked most per category in each window."""
    return top_per_window(counts, "n", "product", n, "category")


def valid_clicks(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not flagged in the blacklist (user_id, flag); a null flag does not count."""
    return join_static(clicks, blacklist.filter("flag").select("user_id"), "user_id", "left_anti")


def purchases(events: DataFrame) -> DataFrame:
    """Purchases (user_id, product, price) of a click log."""
    bought = events.filter(F.col("category") == "purchase")
    return bought.select("user_id", "product", F.col("value").alias("price"))
