"""Scans, sources and sinks (S).

A sink writes a whole table to new files in the shared scratch folder; the query
returns what a scan reads back.  Database queries are not registered: they need a
database, see ``sources/jdbc.py``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import matrices as M
from millrace.functions import scalars as S
from millrace.operators import joins as J
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import read_table, scratch_path
from millrace.sources import files, images, tables


@query(
    "s01_scan_text",
    "SELECT c_custkey || ' ' || c_mktsegment AS value, c_mktsegment AS segment FROM customer",
)
def scan_text(spark, base):
    path = scratch_path(spark, "text")
    customer = read_table(spark, base, "customer")
    files.sink_text(
        customer, path, F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_mktsegment")
    )
    lines = files.scan_text(spark, path)
    return lines.withColumn("segment", S.split_get(F.col("value"), " ", 1))


@query(
    "s02_scan_delimited",
    I.with_tables("news_access")
    + "SELECT date, user_id, page_id, section, action FROM news_access",
)
def scan_delimited(spark, base):
    path = scratch_path(spark, "delimited")
    columns = ["date", "user_id", "page_id", "section", "action"]
    files.sink_delimited(
        I.news_access(spark, base).select(*columns), path, sep="\t", null_text="null"
    )
    schema = "date date, user_id long, page_id long, section string, action string"
    return files.scan_delimited(spark, path, schema, "\t", null_text="null")


@query(
    "s03_scan_json",
    I.with_tables("employee")
    + "SELECT name, age, CAST(dep_id AS BIGINT) AS dep_id, gender, salary FROM employee",
)
def scan_json(spark, base):
    path = scratch_path(spark, "json")
    staff = I.employee(spark, base).select("name", "age", "dep_id", "gender", "salary")
    files.sink_json(staff, path)
    return files.scan_json(spark, path).select("name", "age", "dep_id", "gender", "salary")


@query(
    "s04_scan_json_strings",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
    "event_type AS kind FROM events",
)
def scan_json_strings(spark, base):
    nested = F.to_json(F.struct("props", F.struct("event_type").alias("about")))
    events = read_table(spark, base, "events").select("event_id", nested.alias("doc"))
    outer = files.scan_json_strings(
        events, "doc", "props string, about struct<event_type: string>", "outer"
    )
    inner = files.scan_json_strings(
        outer.select("event_id", "outer.about.event_type", F.col("outer.props").alias("props")),
        "props",
    )
    return inner.select("event_id", F.col("parsed.k").alias("k"), F.col("event_type").alias("kind"))


@query("s05_scan_parquet", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def scan_parquet(spark, base):
    return files.scan_parquet(spark, f"{base}/supplier.parquet").select(
        "s_suppkey", "s_name", "s_acctbal"
    )


@query("s06_scan_path_sql", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def scan_path_sql(spark, base):
    return files.scan_path_sql(
        spark, f"{base}/part.parquet", ["p_partkey", "p_brand", "p_retailprice"]
    )


@query(
    "s07_scan_merge_schema",
    "SELECT o_orderkey AS id, o_totalprice AS price, NULL::VARCHAR AS status, 1 AS key FROM orders "
    "UNION ALL SELECT o_orderkey, NULL, o_orderstatus, 2 FROM orders",
)
def scan_merge_schema(spark, base):
    path = scratch_path(spark, "merge")
    orders = read_table(spark, base, "orders")
    key = F.col("o_orderkey").alias("id")
    files.sink_parquet(orders.select(key, F.col("o_totalprice").alias("price")), f"{path}/key=1")
    files.sink_parquet(orders.select(key, F.col("o_orderstatus").alias("status")), f"{path}/key=2")
    return files.scan_parquet(spark, path, merge_schema=True).select("id", "price", "status", "key")


@query(
    "s08_scan_partitioned",
    "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders "
    "WHERE year(o_orderdate) >= 1998",
)
def scan_partitioned(spark, base):
    path = scratch_path(spark, "partitioned")
    orders = read_table(spark, base, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")
    )
    files.sink_parquet(orders, path, mode="overwrite", partition_by=["year"])
    return files.scan_partitioned(spark, path).filter("year >= 1998")


@query(
    "s11_table_create_load",
    "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier UNION ALL "
    "SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def table_create_load(spark, base):
    target = scratch_path(spark, "loaded")
    table = "millrace_" + target.rsplit("-", 1)[1]
    schema = "id long, name string, balance double"
    for name, prefix, key in (("supplier", "s", "suppkey"), ("customer", "c", "custkey")):
        source = scratch_path(spark, f"load-{name}")
        rows = read_table(spark, base, name).select(f"{prefix}_{key}", f"{prefix}_name", f"{prefix}_acctbal")
        files.sink_delimited(rows, source, sep="\u0001")
        loaded = tables.table_create_load(
            spark, table, source, schema, "\u0001", overwrite=name == "supplier", location=target
        )
    return loaded


@query(
    "s12_table_save_read",
    I.with_tables("employee") + "SELECT emp_id, salary FROM employee",
)
def table_save_read(spark, base):
    target = scratch_path(spark, "saved")
    staff = I.employee(spark, base).select("emp_id", "salary")
    return tables.table_save_read(
        staff, "millrace_" + target.rsplit("-", 1)[1], location=target
    )


@query(
    "s13_sink_json",
    I.with_tables("employee") + "SELECT emp_id, name, age FROM employee WHERE age > 30",
)
def sink_json(spark, base):
    path = scratch_path(spark, "json-sink")
    files.sink_json(I.employee(spark, base).filter("age > 30").select("emp_id", "name", "age"), path)
    return files.scan_json(spark, path, "emp_id long, name string, age long")


@query(
    "s14_sink_parquet_append",
    "SELECT c_custkey AS key, c_acctbal AS balance FROM customer UNION ALL "
    "SELECT s_suppkey, s_acctbal FROM supplier",
)
def sink_parquet_append(spark, base):
    path = scratch_path(spark, "append")
    for name, prefix, key in (("customer", "c", "custkey"), ("supplier", "s", "suppkey")):
        rows = read_table(spark, base, name).select(
            F.col(f"{prefix}_{key}").alias("key"), F.col(f"{prefix}_acctbal").alias("balance")
        )
        files.sink_parquet(rows, path)
    return files.scan_parquet(spark, path)


@query(
    "s15_scan_libsvm",
    I.with_tables("vec")
    + "SELECT CAST(label AS DOUBLE) AS label, 64 AS size, round(v[1], 6) AS first, "
    "round(list_sum(v), 6) AS total FROM vec",
)
def scan_libsvm(spark, base):
    path = scratch_path(spark, "libsvm")
    rows = I.vec(spark, base).select(
        F.col("label").cast("double").alias("label"), array_to_vector("v").alias("features")
    )
    files.sink_libsvm(rows, path)
    back = files.scan_libsvm(spark, path, features=64)
    v = vector_to_array("features")
    return back.select(
        "label",
        F.size(v).alias("size"),
        F.round(F.get(v, F.lit(0)), 6).alias("first"),
        F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + x), 6).alias("total"),
    )


@query(
    "s16_scan_images_to_vectors",
    """SELECT vec_id, CASE WHEN label <> 0 THEN 16 END AS size, CASE WHEN label <> 0 THEN CAST(list_sum(g) AS BIGINT) END AS total,
              CASE WHEN label <> 0 THEN CAST(g[1] AS DOUBLE) END AS first
       FROM (SELECT vec_id, label, list_transform([10, 12, 14, 16, 26, 28, 30, 32, 42, 44, 46, 48, 58, 60,
             62, 64], lambda p: CAST(floor(least(greatest(embedding[p]::DOUBLE, -1), 1) * 127)
             AS INTEGER) + 128) AS g FROM embeddings)""",
)
def scan_images_to_vectors(spark, base):
    # Each embedding becomes a file, an 8x8 gray image; those of label 0 are damaged.
    level = lambda x: (F.floor(F.least(F.greatest(x.cast("double"), F.lit(-1.0)), F.lit(1.0)) * 127) + 128).cast("int")
    data = images.encode_png(F.transform("embedding", level), 8, 8)
    rows = read_table(spark, base, "embeddings").select(
        F.concat(F.col("vec_id").cast("string"), F.lit(".png")).alias("name"),
        F.when(F.col("label") == 0, F.substring(data, 9, 20)).otherwise(data).alias("data"),
    )
    folder = scratch_path(spark, "s16")
    images.sink_files(rows, folder, "name", "data")
    found = files.scan_images(spark, folder, "[0-9]*.png")
    small = found.select(
        F.regexp_extract("path", r"(\d+)\.png$", 1).cast("long").alias("vec_id"),
        images.pixel_vector(F.col("image"), 4, 4).alias("g"),
    )
    return small.select(
        "vec_id",
        F.when(F.col("g").isNotNull(), F.size("g")).alias("size"),
        F.aggregate("g", F.lit(0.0), lambda s, x: s + x).cast("long").alias("total"),
        F.get("g", F.lit(0)).alias("first"),
    )


EVENT_CODES = [("click", 1), ("view", 2), ("purchase", 3), ("signup", 4), ("error", 5)]


@query(
    "s17_frame_from_rows",
    "SELECT event_id, CAST(code AS BIGINT) AS code FROM events JOIN (VALUES ('click', 1), "
    "('view', 2), ('purchase', 3), ('signup', 4), ('error', 5)) t(event_type, code) USING (event_type)",
)
def frame_from_rows(spark, base):
    codes = tables.frame_from_rows(spark, EVENT_CODES, ["event_type", "code"])
    events = read_table(spark, base, "events").select("event_id", "event_type")
    return J.join_code_table(events, codes, "event_type").select("event_id", "code")


@query(
    "s18_frame_with_schema",
    I.with_tables("news_access")
    + "SELECT strftime(date, '%Y-%m-%d') AS date, CAST(user_id AS INTEGER) AS user_id FROM news_access",
)
def frame_with_schema(spark, base):
    schema = T.StructType(
        [T.StructField("date", T.StringType()), T.StructField("user_id", T.IntegerType())]
    )
    raw = I.news_access(spark, base).select(
        F.col("date").cast("string"), F.col("user_id").cast("string")
    )
    return tables.frame_with_schema(raw, schema)


@query(
    "s19_sink_matrix_csv",
    I.with_tables("entries") + "SELECT i, j, v FROM entries",
)
def sink_matrix_csv(spark, base):
    path = scratch_path(spark, "matrix")
    entries = M.to_entries(read_table(spark, base, "embeddings"), "vec_id", "embedding")
    files.sink_matrix_csv(entries, path)
    return files.scan_delimited(spark, path, "i long, j long, v double", ",")
