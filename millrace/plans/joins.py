"""Joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.ml import cluster, recommend
from millrace.operators import joins as J
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import read_table


@query(
    "j01_join_inner",
    "SELECT o_orderkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(spark, base):
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey")
    return J.join_inner(orders, customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "c_name", "c_nationkey"
    )


@query(
    "j02_join_inner_sql",
    "SELECT o.o_orderkey, l.l_linenumber, l.l_extendedprice FROM orders o "
    "JOIN lineitem l ON o.o_orderkey = l.l_orderkey "
    "WHERE o.o_orderstatus = 'F' AND l.l_quantity >= 40",
)
def join_inner_sql(spark, base):
    return spark.sql(
        "SELECT o.o_orderkey, l.l_linenumber, l.l_extendedprice FROM {orders} o "
        "JOIN {lines} l ON o.o_orderkey = l.l_orderkey "
        "WHERE o.o_orderstatus = :status AND l.l_quantity >= :quantity",
        args={"status": "F", "quantity": 40},
        orders=read_table(spark, base, "orders"),
        lines=read_table(spark, base, "lineitem"),
    )


@query(
    "j03_join_pairs",
    "SELECT p_partkey AS key, p_retailprice AS price, a.mean FROM part JOIN "
    "(SELECT l_partkey, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_partkey) a "
    "ON p_partkey = l_partkey",
)
def join_pairs(spark, base):
    price = read_table(spark, base, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("price")
    )
    mean = (
        read_table(spark, base, "lineitem")
        .groupBy(F.col("l_partkey").alias("key"))
        .agg(F.round(F.avg("l_quantity"), 6).alias("mean"))
    )
    return J.join_inner(price, mean, "key")


@query(
    "j04_join_struct",
    "SELECT s_suppkey AS supplier_key, s_acctbal AS balance, n_name AS nation_name "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def join_struct(spark, base):
    both = J.join_struct(
        read_table(spark, base, "supplier"),
        read_table(spark, base, "nation"),
        F.col("l.s_nationkey") == F.col("r.n_nationkey"),
    )
    return both.select(
        F.col("l.s_suppkey").alias("supplier_key"),
        F.col("l.s_acctbal").alias("balance"),
        F.col("r.n_name").alias("nation_name"),
    )


@query(
    "j05_join_semi",
    "SELECT p_partkey, p_name FROM part WHERE EXISTS "
    "(SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_discount >= 0.1)",
)
def join_semi(spark, base):
    lines = read_table(spark, base, "lineitem").filter("l_discount >= 0.1")
    keys = lines.select(F.col("l_partkey").alias("p_partkey"))
    return J.join_semi(read_table(spark, base, "part"), keys, "p_partkey").select(
        "p_partkey", "p_name"
    )


@query(
    "j06_join_anti_blacklist",
    I.with_tables("blacklist")
    + "SELECT event_id, user_id FROM events WHERE event_type = 'click' "
    "AND user_id NOT IN (SELECT user_id FROM blacklist WHERE flag)",
)
def join_anti_blacklist(spark, base):
    clicks = read_table(spark, base, "events").filter("event_type = 'click'")
    return J.join_anti_flagged(
        clicks.select("event_id", "user_id"), I.blacklist(spark, base), "user_id"
    )


@query(
    "j07_join_outer_flag",
    "SELECT c_custkey, coalesce(n, 0) AS n_large FROM customer LEFT JOIN "
    "(SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey) "
    "ON c_custkey = o_custkey",
)
def join_outer_flag(spark, base):
    large = (
        read_table(spark, base, "orders")
        .filter("o_totalprice > 400000")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n_large"))
    )
    customer = read_table(spark, base, "customer").select("c_custkey")
    return J.join_outer_default(customer, large, "c_custkey", {"n_large": 0})


@query(
    "j09_zip_by_row_id",
    I.with_tables("vec")
    + "SELECT vec_id, label, CAST(list_position(v, list_max(v)) - 1 AS BIGINT) AS guess, "
    "label = list_position(v, list_max(v)) - 1 AS hit FROM vec",
)
def zip_by_row_id(spark, base):
    rows = I.vec(spark, base)
    truth = rows.select("vec_id", "label")
    guess = rows.select("vec_id", V.argmax(F.col("v")).alias("guess"))
    return J.zip_by_row_id(truth, guess, "vec_id").withColumn(
        "hit", F.col("label") == F.col("guess")
    )


@query(
    "j10_cross_score",
    I.with_tables("entries")
    + """, centre AS (SELECT label, j, avg(v) AS v
              FROM entries JOIN embeddings ON vec_id = i GROUP BY label, j),
         score AS (SELECT e.i AS user_no, c.label AS item, sum(e.v * c.v) AS score
              FROM entries e JOIN centre c ON e.j = c.j GROUP BY e.i, c.label)
         SELECT user_no, CAST(item AS BIGINT) AS item, round(score, 6) AS score,
                CAST(rank AS INTEGER) AS rank FROM
         (SELECT *, row_number() OVER (PARTITION BY user_no ORDER BY score DESC, item) AS rank
          FROM score) WHERE rank <= 3""",
)
def cross_score(spark, base):
    rows = I.vec(spark, base)
    items = cluster.group_centres(rows, "label", "v").toDF("item", "f")
    users = rows.select(F.col("vec_id").alias("user_no"), F.col("v").alias("f"))
    top = recommend.top_scored_items(users, items, "user_no", "item", "f", 3)
    return top.withColumn("score", F.round("score", 6))


@query(
    "j11_join_map_side",
    "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey",
)
def join_map_side(spark, base):
    nation = read_table(spark, base, "nation").join(
        read_table(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = read_table(spark, base, "customer")
    codes = nation.select("n_nationkey", "n_name", "r_name")
    return J.join_code_table(
        customer, codes, customer.c_nationkey == codes.n_nationkey
    ).select("c_custkey", "n_name", "r_name")

