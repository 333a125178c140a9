"""The reports' input tables, derived from the base tables, in Spark and in SQL.

Each function has a twin SQL text under the same name in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialise, read_table

SQL = {
    "employee": """SELECT c_custkey AS emp_id, c_name AS name, 18 + c_custkey % 50 AS age,
        c_nationkey AS dep_id, c_mktsegment AS gender, c_acctbal AS salary FROM customer""",
    "department": "SELECT n_nationkey AS id, n_name AS dep_name FROM nation",
    "news_access": """SELECT event_id, CAST(ts AS DATE) AS date, ts,
        CASE WHEN value >= 5 THEN user_id END AS user_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS page_id,
        'section_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 AS VARCHAR) AS section,
        event_type AS action FROM events""",
    "click_log": """SELECT event_id, ts, user_id, event_type AS category, value,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS product FROM events""",
    "blacklist": """SELECT user_id, count(*) FILTER (WHERE event_type = 'error') > 15 AS flag
        FROM events GROUP BY user_id""",
    "rating": """SELECT o_custkey AS user_no, l_partkey AS item,
        avg(1 + floor((l_quantity - 1) / 10)) AS rating
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey""",
    "product_sales": """SELECT l_partkey AS product, p_type AS category,
        round(sum(l_extendedprice), 2) AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_type""",
    "vec": "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "entries": """SELECT vec_id AS i, CAST(p - 1 AS BIGINT) AS j, CAST(embedding[p] AS DOUBLE) AS v
        FROM embeddings, range(1, 65) r(p)""",
}


def with_tables(*names: str) -> str:
    """A WITH clause that defines the named derived tables."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " "


def employee(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "customer").select(
        F.col("c_custkey").alias("emp_id"),
        F.col("c_name").alias("name"),
        (18 + F.col("c_custkey") % 50).alias("age"),
        F.col("c_nationkey").alias("dep_id"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_acctbal").alias("salary"),
    )


def department(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("dep_name")
    )


def page_number(props="props"):
    return F.get_json_object(F.col(props), "$.k").cast("long")


def as_news_access(events: DataFrame) -> DataFrame:
    """Access log rows: a visit of small value counts as anonymous.

    The action is the event type as it stands, so filters on it reach the scan.
    """
    page = page_number()
    return events.select(
        "event_id",
        F.to_date("ts").alias("date"),
        "ts",
        F.when(F.col("value") >= 5, F.col("user_id")).alias("user_id"),
        page.alias("page_id"),
        F.concat(F.lit("section_"), F.expr("cast(get_json_object(props, '$.k') as long) div 10")
                 .cast("string")).alias("section"),
        F.col("event_type").alias("action"),
    )


def news_access(spark: SparkSession, base: str) -> DataFrame:
    return as_news_access(read_table(spark, base, "events"))


def as_click_log(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("category"), "value",
        page_number().alias("product"),
    )


def click_log(spark: SparkSession, base: str) -> DataFrame:
    return as_click_log(read_table(spark, base, "events"))


def blacklist(spark: SparkSession, base: str) -> DataFrame:
    """Users flagged for many error events."""
    errors = F.count_if(F.col("event_type") == "error")
    users = read_table(spark, base, "events").groupBy("user_id")
    return materialise(users.agg((errors > 15).alias("flag")), "blacklist")


def rating(spark: SparkSession, base: str) -> DataFrame:
    """Ratings from 1 to 5 of parts by customers, from the quantities they ordered."""
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey)
        .groupBy("o_custkey", "l_partkey")
        .agg(F.avg(1 + F.floor((F.col("l_quantity") - 1) / 10)).alias("rating"))
        .select(
            F.col("o_custkey").alias("user_no"),
            F.col("l_partkey").alias("item"),
            "rating",
        )
    )


def product_sales(spark: SparkSession, base: str) -> DataFrame:
    """Revenue per product, added up before the join with the product table."""
    revenue = (
        read_table(spark, base, "lineitem")
        .groupBy("l_partkey")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    )
    part = read_table(spark, base, "part").select("p_partkey", "p_type")
    return revenue.join(part, revenue.l_partkey == part.p_partkey).select(
        F.col("l_partkey").alias("product"), F.col("p_type").alias("category"), "revenue"
    )


def vec(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")
    )
