"""Windows, orders, limits and top-n (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.ml.cluster import members_near_centre
from millrace.operators import topn as W
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import read_table


@query(
    "w01_row_number_topn",
    I.with_tables("product_sales")
    + "SELECT product, category, revenue, CAST(rank AS INTEGER) AS rank FROM "
    "(SELECT *, row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product) AS rank "
    "FROM product_sales) WHERE rank <= 3",
)
def row_number_topn(spark, base):
    sales = I.product_sales(spark, base)
    return W.top_n_per_group(sales, "category", [F.desc("revenue"), F.asc("product")], 3)


@query(
    "w02_group_topn_array",
    "SELECT o_custkey, t[1] AS first, t[2] AS second, t[3] AS third FROM "
    "(SELECT o_custkey, list(o_totalprice ORDER BY o_totalprice DESC) AS t FROM orders "
    "GROUP BY o_custkey)",
)
def group_topn_array(spark, base):
    top = W.group_topn_array(read_table(spark, base, "orders"), "o_custkey", "o_totalprice", 3)
    return top.select(
        "o_custkey",
        *[F.get("top", F.lit(i)).alias(n) for i, n in enumerate(("first", "second", "third"))],
    )


@query(
    "w03_global_topn",
    "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_partkey LIMIT 3",
)
def global_topn(spark, base):
    lines = read_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return W.global_topn(lines, [F.desc("l_extendedprice"), "l_orderkey", "l_partkey"], 3)


@query(
    "w04_topk_excluding_self",
    I.with_tables("entries")
    + """, dots AS (SELECT b.i, sum(a.v * b.v) AS ab, sqrt(sum(a.v * a.v)) AS na,
                 sqrt(sum(b.v * b.v)) AS nb
            FROM entries a JOIN entries b ON a.j = b.j WHERE a.i = 7 AND b.i <> 7 GROUP BY b.i)
         SELECT i AS vec_id, round(ab / (na * nb), 6) AS similarity FROM dots
         ORDER BY ab / (na * nb) DESC, i LIMIT 10""",
)
def topk_excluding_self(spark, base):
    rows = I.vec(spark, base)
    target = rows.filter(F.col("vec_id") == 7).select("v").scalar()
    others = rows.filter(F.col("vec_id") != 7).withColumn("target", target)
    scored = others.select(
        "vec_id", V.cosine(F.col("v"), F.col("target")).alias("similarity")
    )
    return W.global_topn(scored, [F.desc("similarity"), "vec_id"], 10).withColumn(
        "similarity", F.round("similarity", 6)
    )


@query(
    "w05_topn_nearest_per_group",
    I.with_tables("entries")
    + """, centre AS (SELECT label, j, avg(v) AS c
              FROM entries JOIN embeddings ON vec_id = i GROUP BY label, j),
         dist AS (SELECT e.i AS vec_id, m.label, sum((e.v - c.c) * (e.v - c.c)) AS d
              FROM entries e JOIN embeddings m ON m.vec_id = e.i
              JOIN centre c ON c.label = m.label AND c.j = e.j GROUP BY e.i, m.label)
         SELECT vec_id, label, round(d, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM
         (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(d, 9), vec_id) AS rank
          FROM dist) WHERE rank <= 20""",
)
def topn_nearest_per_group(spark, base):
    rows = I.vec(spark, base)
    near = members_near_centre(rows, "vec_id", "label", "v", 20)
    return near.withColumn("distance", F.round("distance", 6))


@query(
    "w06_topn_of_key",
    I.with_tables("rating")
    + "SELECT p_name, item, round(rating, 4) AS rating FROM rating JOIN part ON item = p_partkey "
    "WHERE user_no = 89 ORDER BY rating.rating DESC, item LIMIT 10",
)
def topn_of_key(spark, base):
    top = W.topn_of_key(
        I.rating(spark, base), "user_no", 89, [F.desc("rating"), F.asc("item")], 10
    )
    part = read_table(spark, base, "part").select("p_partkey", "p_name")
    return top.join(part, F.col("item") == F.col("p_partkey")).select(
        "p_name", "item", F.round("rating", 4).alias("rating")
    )


@query(
    "w07_argmax_row",
    I.with_tables("click_log")
    + "SELECT product, count(*) AS n FROM click_log WHERE category = 'purchase' "
    "GROUP BY product ORDER BY n DESC, product LIMIT 1",
)
def argmax_row(spark, base):
    bought = I.click_log(spark, base).filter("category = 'purchase'")
    return W.argmax_row(bought.groupBy("product").agg(F.count("*").alias("n")), "n", "product")


@query(
    "w08_sort_desc",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey",
)
def sort_desc(spark, base):
    customer = read_table(spark, base, "customer").select("c_custkey", "c_acctbal")
    return W.sort_rows(customer, F.desc("c_acctbal"), "c_custkey")


@query(
    "w09_secondary_sort",
    "SELECT l_partkey, l_suppkey, l_orderkey FROM lineitem ORDER BY 1, 2, 3",
)
def secondary_sort(spark, base):
    lines = read_table(spark, base, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    return W.secondary_sort(lines, "l_partkey", "l_suppkey", "l_orderkey")


@query(
    "w10_order_by_sql",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice >= 100000 ORDER BY o_orderkey",
)
def order_by_sql(spark, base):
    return spark.sql(
        "SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_totalprice >= :least "
        "ORDER BY o_orderkey",
        args={"least": 100000},
        orders=read_table(spark, base, "orders"),
    )


@query("w11_take_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 3")
def take_n(spark, base):
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_totalprice")
    return W.global_topn(orders, ["o_orderkey"], 3)
