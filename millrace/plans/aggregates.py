"""Aggregates (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import transforms as P
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import read_table

# Values per list in the grouped-values queries.
PARTS = 4


@query(
    "a01_word_count",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word "
    "FROM documents) WHERE word <> '' GROUP BY word",
)
def word_count(spark, base):
    return A.word_count(read_table(spark, base, "documents"), "text")


@query(
    "a02_aggregate_by_key",
    I.with_tables("click_log")
    + "SELECT user_id, CAST(sum(product) AS BIGINT) AS total, max(product) AS largest "
    "FROM click_log GROUP BY user_id",
)
def aggregate_by_key(spark, base):
    return A.aggregate_by_key(
        I.click_log(spark, base), "user_id", total=F.sum("product"), largest=F.max("product")
    )


@query(
    "a03_combine_by_key_avg",
    "SELECT l_partkey, sum(l_quantity) AS total, count(*) AS n, round(avg(l_quantity), 6) AS mean "
    "FROM lineitem GROUP BY l_partkey",
)
def combine_by_key_avg(spark, base):
    combined = A.combine_by_key_avg(
        read_table(spark, base, "lineitem"), "l_partkey", "l_quantity"
    )
    return combined.withColumn("mean", F.round("mean", 6))


def _parts_sql(rows: str, key: str, value: str, spread: str) -> str:
    return f"""SELECT {key}, CAST(('0x' || substr(md5(CAST({spread} AS VARCHAR)), 1, 8))::BIGINT % {PARTS} AS INTEGER) AS part,
        string_agg(CAST({value} AS VARCHAR), ',' ORDER BY {value}) AS vals
        FROM ({rows}) GROUP BY 1, 2"""


@query(
    "a04_group_values",
    _parts_sql(
        "SELECT o_custkey, o_orderkey FROM orders", "o_custkey", "o_orderkey", "o_orderkey"
    ),
)
def group_values(spark, base):
    orders = read_table(spark, base, "orders").withColumn("row_id", F.col("o_orderkey"))
    grouped = A.group_values(orders, "o_custkey", "o_orderkey", "row_id", parts=PARTS)
    return grouped.select(
        "o_custkey", "part", F.array_join(F.col("values").cast("array<string>"), ",").alias("vals")
    )


@query(
    "a05_basic_aggregates",
    I.with_tables("employee", "department")
    + "SELECT dep_name, round(avg(salary), 4) AS mean, round(sum(salary), 2) AS total, "
    "max(salary) AS largest, min(salary) AS smallest, count(*) AS n, "
    "count(DISTINCT gender) AS n_distinct FROM employee JOIN department ON dep_id = id "
    "GROUP BY dep_name",
)
def basic_aggregates(spark, base):
    staff = I.employee(spark, base)
    department = I.department(spark, base)
    joined = staff.join(department, staff.dep_id == department.id)
    return A.basic_aggregates(joined, "dep_name", "salary", "gender").withColumns(
        {"mean": F.round("mean", 4), "total": F.round("total", 2)}
    )


@query(
    "a06_count_distinct",
    "SELECT o_orderpriority, o_orderstatus, count(DISTINCT o_custkey) AS n_distinct "
    "FROM orders GROUP BY o_orderpriority, o_orderstatus",
)
def count_distinct(spark, base):
    return A.count_distinct(
        read_table(spark, base, "orders"), ["o_orderpriority", "o_orderstatus"], "o_custkey"
    )


@query(
    "a07_collect_list_set",
    "SELECT kind, p_brand, part, vals FROM ("
    + "SELECT 'list' AS kind, * FROM ("
    + _parts_sql("SELECT p_brand, p_type, p_partkey FROM part", "p_brand", "p_type", "p_partkey")
    + ") UNION ALL SELECT 'set' AS kind, * FROM ("
    + _parts_sql(
        "SELECT p_brand, p_type, min(p_partkey) AS p_partkey FROM part GROUP BY p_brand, p_type",
        "p_brand",
        "p_type",
        "p_partkey",
    )
    + "))",
)
def collect_list_set(spark, base):
    part = read_table(spark, base, "part")
    names = {}
    for kind in ("list", "set"):
        grouped = A.group_values(
            part, "p_brand", "p_type", "p_partkey", distinct=kind == "set", parts=PARTS
        )
        names[kind] = grouped.select(
            F.lit(kind).alias("kind"),
            "p_brand",
            "part",
            F.array_join("values", ",").alias("vals"),
        )
    return names["list"].unionByName(names["set"])


@query("a08_global_distinct_count", "SELECT count(DISTINCT user_id) AS n_users FROM events")
def global_distinct_count(spark, base):
    return P.summary_row(
        read_table(spark, base, "events"), {"n_users": F.countDistinct("user_id")}
    )


@query(
    "a09_global_reduce",
    "SELECT round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS mean, "
    "count(*) AS n FROM lineitem",
)
def global_reduce(spark, base):
    return P.summary_row(
        read_table(spark, base, "lineitem"),
        {
            "total": F.round(F.sum("l_extendedprice"), 2),
            "mean": F.round(F.avg("l_extendedprice"), 4),
            "n": F.count("*"),
        },
    )


@query(
    "a10_group_by_two_keys",
    I.with_tables("employee")
    + "SELECT dep_id, gender, round(avg(salary), 4) AS mean_salary, "
    "round(avg(age), 4) AS mean_age FROM employee GROUP BY dep_id, gender",
)
def group_by_two_keys(spark, base):
    return A.aggregate_by_key(
        I.employee(spark, base),
        ["dep_id", "gender"],
        mean_salary=F.round(F.avg("salary"), 4),
        mean_age=F.round(F.avg("age"), 4),
    )


@query(
    "a11_having_count",
    I.with_tables("news_access")
    + "SELECT date, count(*) AS n_single FROM (SELECT date, user_id FROM news_access "
    "WHERE action = 'view' AND user_id IS NOT NULL GROUP BY date, user_id HAVING count(*) = 1) "
    "GROUP BY date",
)
def having_count(spark, base):
    views = I.news_access(spark, base).filter("action = 'view' AND user_id IS NOT NULL")
    single = A.having_count(views, ["date", "user_id"], 1)
    return single.groupBy("date").agg(F.count("*").alias("n_single"))


@query(
    "a12_distinct_by_double_group",
    I.with_tables("news_access")
    + "SELECT date, page_id, count(*) AS n_distinct FROM (SELECT DISTINCT date, page_id, user_id "
    "FROM news_access WHERE action = 'view') GROUP BY date, page_id",
)
def distinct_by_double_group(spark, base):
    views = I.news_access(spark, base).filter("action = 'view'")
    return A.distinct_by_double_group(views, ["date", "page_id"], "user_id")


@query(
    "a13_ratio_of_counts",
    I.with_tables("news_access")
    + "SELECT section, numerator, denominator, "
    "round(numerator / nullif(denominator, 0), 2) AS rate FROM (SELECT section, "
    "count(*) FILTER (WHERE action = 'purchase') AS numerator, "
    "count(*) FILTER (WHERE action = 'click') AS denominator FROM news_access GROUP BY section)",
)
def ratio_of_counts(spark, base):
    return A.ratio_of_counts(
        I.news_access(spark, base),
        ["section"],
        F.col("action") == "purchase",
        F.col("action") == "click",
    )


@query(
    "a14_column_summary",
    I.with_tables("entries")
    + "SELECT CAST(j AS INTEGER) AS pos, count(*) AS n, round(avg(v), 8) AS mean, "
    "round(var_samp(v), 8) AS variance, count(*) FILTER (WHERE v <> 0) AS non_zeros, "
    "max(v) AS largest, min(v) AS smallest, round(sum(abs(v)), 6) AS norm_l1, "
    "round(sqrt(sum(v * v)), 6) AS norm_l2 FROM entries GROUP BY j",
)
def column_summary(spark, base):
    summary = A.column_summary(read_table(spark, base, "embeddings"), "embedding")
    digits = {"mean": 8, "variance": 8, "norm_l1": 6, "norm_l2": 6}
    return summary.withColumns({n: F.round(n, d) for n, d in digits.items()})


@query(
    "a15_distinct_index",
    "SELECT source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS BIGINT) AS idx "
    "FROM (SELECT DISTINCT source FROM documents)",
)
def distinct_index(spark, base):
    return A.distinct_index(read_table(spark, base, "documents"), "source")


@query("a16_count_star", "SELECT count(*) AS n FROM lineitem")
def count_star(spark, base):
    return A.count_rows(read_table(spark, base, "lineitem"))


@query(
    "a17_group_by_count",
    I.with_tables("employee") + "SELECT age, count(*) AS n FROM employee GROUP BY age",
)
def group_by_count(spark, base):
    return A.aggregate_by_key(I.employee(spark, base), "age", n=F.count("*"))
