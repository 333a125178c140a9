"""Samples and splits (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import sampling as X
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import read_table


@query(
    "x01_sample_fraction",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE ('0x' || substr(md5(o_orderkey || '|7'), 1, 8))::BIGINT / 4294967296.0 < 0.1""",
)
def sample_fraction(spark, base):
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_totalprice")
    return X.sample_fraction(orders, ["o_orderkey"], 0.1, seed=7)


@query(
    "x02_random_split",
    """SELECT event_id, CASE WHEN h < 3.0 / 33 THEN 0 WHEN h < 13.0 / 33 THEN 1 ELSE 2 END AS part
       FROM (SELECT event_id, ('0x' || substr(md5(event_id || '|123'), 1, 8))::BIGINT
             / 4294967296.0 AS h FROM events)""",
)
def random_split(spark, base):
    events = read_table(spark, base, "events").select("event_id")
    return X.random_split(events, ["event_id"], [3, 10, 20], seed=123)


@query(
    "x03_kfold_blocks",
    "SELECT event_id, CAST(ntile(5) OVER (ORDER BY event_id) AS INTEGER) AS fold FROM events",
)
def kfold_blocks(spark, base):
    events = read_table(spark, base, "events").select("event_id")
    return X.kfold_blocks(events, "event_id", 5)


@query(
    "x04_holdout_nth_per_user",
    """SELECT event_id, user_id, coalesce(rn BETWEEN 1 AND 10 AND
              row_number() OVER (PARTITION BY rn BETWEEN 1 AND 10 ORDER BY event_id) <= 1000,
              false) AS is_test
       FROM (SELECT event_id, user_id,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)""",
)
def holdout_nth_per_user(spark, base):
    events = read_table(spark, base, "events").select("event_id", "user_id")
    return X.holdout_nth_per_user(events, "user_id", "event_id", 1, 10, max_test=1000)
