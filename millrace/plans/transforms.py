"""Projections, filters and row-wise transforms (P)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import joins as J
from millrace.operators import transforms as P
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import materialise, read_table


@query("p01_select_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def select_columns(spark, base):
    return P.select_columns(read_table(spark, base, "orders"), "o_orderkey", "o_orderstatus")


@query(
    "p02_computed_column",
    I.with_tables("employee")
    + "SELECT emp_id, age + 1 AS next_age, round(salary + 1000, 2) AS raised FROM employee",
)
def computed_column(spark, base):
    return P.computed_column(
        I.employee(spark, base), next_age="age + 1", raised=F.round(F.col("salary") + 1000, 2)
    ).select("emp_id", "next_age", "raised")


@query(
    "p03_filter_expr",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
    "WHERE l_quantity > 30 AND l_discount < 0.05",
)
def filter_expr(spark, base):
    lines = read_table(spark, base, "lineitem")
    return P.filter_expr(
        P.filter_expr(lines, "l_quantity > 30"), F.col("l_discount") < 0.05
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "p04_filter_between",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000",
)
def filter_between(spark, base):
    orders = read_table(spark, base, "orders")
    return P.filter_between(orders, "o_totalprice", 100000, 200000).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "p05_filter_null",
    I.with_tables("news_access")
    + "SELECT event_id, page_id, action FROM news_access "
    "WHERE (user_id IS NULL AND action = 'view') OR (user_id IS NOT NULL AND action = 'signup')",
)
def filter_null(spark, base):
    news = I.news_access(spark, base)
    anonymous = P.filter_null(news, "user_id", action="view")
    known = P.filter_null(news, "user_id", is_null=False, action="signup")
    return anonymous.unionByName(known).select("event_id", "page_id", "action")


@query(
    "p06_filter_conjunction",
    I.with_tables("news_access")
    + "SELECT event_id, page_id FROM news_access WHERE action = 'view' AND section = 'section_3'",
)
def filter_conjunction(spark, base):
    return P.filter_conjunction(
        I.news_access(spark, base), action="view", section="section_3"
    ).select("event_id", "page_id")


@query(
    "p07_filter_in_from_query",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN "
    "(SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
)
def filter_in_from_query(spark, base):
    large = P.filter_expr(read_table(spark, base, "orders"), "o_totalprice > 450000")
    keys = large.select(F.col("o_custkey").alias("c_custkey"))
    return J.join_semi(read_table(spark, base, "customer"), keys, "c_custkey").select(
        "c_custkey", "c_name"
    )


@query(
    "p08_map_format_row",
    "SELECT 'Key: ' || o_orderkey || ', Value: ' || o_orderstatus AS line FROM orders",
)
def map_format_row(spark, base):
    return P.map_format_row(
        read_table(spark, base, "orders"), "Key: {o_orderkey}, Value: {o_orderstatus}"
    )


@query(
    "p09_flat_map",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part "
    "UNION ALL SELECT id, dep_name || '_' || n FROM "
    f"({I.SQL['department']}), (VALUES ('1'), ('2')) t(n)",
)
def flat_map(spark, base):
    part = read_table(spark, base, "part")
    tokens = P.explode_words(part, "p_name", "p_partkey", into="token")
    departments = I.department(spark, base).withColumn("id", F.col("id").cast("long"))
    twice = F.array(*[F.concat("dep_name", F.lit(f"_{n}")) for n in (1, 2)])
    derived = P.flat_map(departments, twice, "token", "id").withColumnRenamed("id", "p_partkey")
    return tokens.unionByName(derived)


@query(
    "p10_map_partitions",
    I.with_tables("employee")
    + "SELECT emp_id, round(salary + 1000, 2) AS raised, upper(name) AS name FROM employee",
)
def map_partitions(spark, base):
    def raise_salary(frame):
        frame["raised"] = (frame["salary"] + 1000).round(2)
        frame["name"] = frame["name"].str.upper()
        return frame[["emp_id", "raised", "name"]]

    rows = I.employee(spark, base).select("emp_id", "name", "salary")
    return P.map_partitions(rows, raise_salary, "emp_id long, raised double, name string")


@query(
    "p11_map_partitions_with_index",
    I.with_tables("employee") + "SELECT emp_id, name, true AS is_numbered FROM employee",
)
def map_partitions_with_index(spark, base):
    # Which partition a row is in depends on the cluster; that it has a number does not.
    names = I.employee(spark, base).select("emp_id", "name")
    parts = names.rdd.getNumPartitions()
    tagged = P.map_partitions_with_index(names).withColumn(
        "tagged_name", F.concat_ws("_", "name", "partition_no")
    )
    number = F.substring_index("tagged_name", "_", -1).cast("int")
    return tagged.select("emp_id", "name", number.between(1, parts).alias("is_numbered"))


EMPLOYEE_TYPE = T.StructType(
    [
        T.StructField("emp_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("salary", T.LongType()),
    ]
)


@query(
    "p12_as_typed",
    I.with_tables("employee")
    + "SELECT CAST(emp_id AS VARCHAR) AS emp_id, name, CAST(age AS INTEGER) AS years, "
    "CAST(trunc(salary) AS BIGINT) AS salary FROM employee",
)
def as_typed(spark, base):
    typed = P.cast_to_schema(I.employee(spark, base), EMPLOYEE_TYPE)
    return typed.toDF("emp_id", "name", "years", "salary")


@query(
    "p13_clean_missing",
    "SELECT event_id, CASE WHEN value < 10 THEN 0.0 ELSE round(value - 50, 2) END AS number, "
    "CASE WHEN value < 10 THEN 0.0 ELSE greatest(round(value - 50, 2), 0.0) END AS non_negative "
    "FROM events",
)
def clean_missing(spark, base):
    shifted = F.round(F.col("value") - 50, 2).cast("string")
    raw = F.when(F.col("value") < 10, F.lit('"?"')).otherwise(
        F.concat(F.lit('"'), shifted, F.lit('"'))
    )
    events = read_table(spark, base, "events").select("event_id", raw.alias("raw"))
    return events.select(
        "event_id",
        P.clean_number(F.col("raw")).alias("number"),
        P.clean_number(F.col("raw"), non_negative=True).alias("non_negative"),
    )


@query(
    "p14_assemble_features",
    "SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, "
    "4 AS width, l_quantity AS first, l_tax AS last FROM lineitem",
)
def assemble_features(spark, base):
    made = P.assemble_features(
        read_table(spark, base, "lineitem"),
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        F.col("l_returnflag") == "R",
        keep=("l_orderkey",),
    )
    return made.select(
        "l_orderkey",
        "label",
        F.size("features").alias("width"),
        F.get("features", F.lit(0)).alias("first"),
        F.get("features", F.lit(3)).alias("last"),
    )


@query(
    "p15_lookup_key",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 89",
)
def lookup_key(spark, base):
    orders = read_table(spark, base, "orders")
    return P.lookup_key(orders, "o_custkey", 89).select("o_orderkey", "o_totalprice")


@query(
    "p16_decode_flags",
    """SELECT p_partkey, coalesce(string_agg(r_name, ' ' ORDER BY r_regionkey), '') AS names
       FROM (SELECT p_partkey, unnest([p_size > 10, p_size > 20, p_size > 30,
                p_retailprice > 950, p_type = 'PROMO']) AS flag, unnest(range(5)) AS idx FROM part)
       LEFT JOIN region ON r_regionkey = idx AND flag GROUP BY p_partkey""",
)
def decode_flags(spark, base):
    tests = ["p_size > 10", "p_size > 20", "p_size > 30", "p_retailprice > 950", "p_type = 'PROMO'"]
    flagged = read_table(spark, base, "part").select(
        "p_partkey", F.array(*[F.expr(t).cast("int") for t in tests]).alias("flags")
    )
    region = read_table(spark, base, "region")
    named = P.decode_flags(flagged, "flags", region, "r_regionkey", "r_name", "names")
    return named.select("p_partkey", F.array_join("names", " ").alias("names"))


@query(
    "p17_repartition_coalesce",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority",
)
def repartition_coalesce(spark, base):
    orders = read_table(spark, base, "orders").select("o_orderpriority")
    parts = orders.rdd.getNumPartitions()
    again = P.relayout(orders, spread=2 * parts, merge=parts)
    return again.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "p18_cache_reuse",
    I.with_tables("employee")
    + "SELECT 'dep' AS kind, CAST(dep_id AS VARCHAR) AS key, count(*) AS n FROM employee "
    "GROUP BY dep_id UNION ALL SELECT 'gender', gender, count(*) FROM employee GROUP BY gender",
)
def cache_reuse(spark, base):
    staff = I.employee(spark, base).select("dep_id", "gender").persist()
    by_dep = staff.groupBy(F.lit("dep").alias("kind"), F.col("dep_id").cast("string").alias("key"))
    by_gender = staff.groupBy(F.lit("gender").alias("kind"), F.col("gender").alias("key"))
    counted = F.count("*").alias("n")
    try:
        return materialise(by_dep.agg(counted).unionByName(by_gender.agg(counted)), "counts")
    finally:
        staff.unpersist()


@query(
    "p19_actions",
    "SELECT count(*) AS n, round(sum(c_acctbal), 2) AS total, min(c_custkey) AS first_key, "
    "min_by(c_name, c_custkey) AS first_name FROM customer",
)
def actions(spark, base):
    return P.summary_row(
        read_table(spark, base, "customer"),
        {
            "n": F.count("*"),
            "total": F.round(F.sum("c_acctbal"), 2),
            "first_key": F.min("c_custkey"),
            "first_name": F.min_by("c_name", "c_custkey"),
        },
    )
