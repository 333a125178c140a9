"""Set operations and duplicate removal (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import setops as D
from millrace.plans.registry import query
from millrace.session import read_table


def _big_spenders(spark, base):
    orders = read_table(spark, base, "orders").filter("o_totalprice > 400000")
    return orders.select(F.col("o_custkey").alias("custkey"))


def _customers(spark, base):
    return read_table(spark, base, "customer").select(F.col("c_custkey").alias("custkey"))


@query(
    "d01_except_distinct",
    "SELECT c_custkey AS custkey FROM customer EXCEPT "
    "SELECT o_custkey FROM orders WHERE o_totalprice > 400000",
)
def except_distinct(spark, base):
    return D.except_distinct(_customers(spark, base), _big_spenders(spark, base))


@query(
    "d02_intersect_distinct",
    "SELECT c_custkey AS custkey FROM customer INTERSECT "
    "SELECT o_custkey FROM orders WHERE o_totalprice > 400000",
)
def intersect_distinct(spark, base):
    return D.intersect_distinct(_customers(spark, base), _big_spenders(spark, base))


@query("d03_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, base):
    lines = read_table(spark, base, "lineitem")
    return D.distinct_rows(lines.select("l_suppkey", "l_returnflag", "l_linestatus"))


@query(
    "d04_drop_duplicates_by",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1",
)
def drop_duplicates_by(spark, base):
    orders = read_table(spark, base, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"
    )
    return D.drop_duplicates_by(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop(
        "o_orderdate"
    )


@query(
    "d05_union_rows",
    "SELECT 'customer' AS kind, c_custkey AS key, c_name AS name FROM customer UNION ALL "
    "SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL "
    "SELECT 'part', p_partkey, p_name FROM part",
)
def union_rows(spark, base):
    def parties(kind, prefix, key):
        return read_table(spark, base, kind).select(
            F.lit(kind).alias("kind"),
            F.col(f"{prefix}_{key}").alias("key"),
            F.col(f"{prefix}_name").alias("name"),
        )

    return D.union_rows(
        parties("customer", "c", "custkey"),
        parties("supplier", "s", "suppkey"),
        parties("part", "p", "partkey"),
    )
