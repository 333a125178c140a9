"""Scalar functions (F) and user-defined functions (U)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions import udfs as U
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import read_table


@query(
    "f01_current_date",
    "SELECT event_type, count(*) FILTER (WHERE CAST(ts AS DATE) <= current_date) AS n_past "
    "FROM events GROUP BY event_type",
)
def current_date(spark, base):
    past = F.count_if(F.to_date("ts") <= F.current_date())
    return read_table(spark, base, "events").groupBy("event_type").agg(past.alias("n_past"))


@query(
    "f02_current_timestamp",
    "SELECT event_type, count(*) FILTER (WHERE ts < current_timestamp::TIMESTAMP) AS n_past "
    "FROM events GROUP BY event_type",
)
def current_timestamp(spark, base):
    past = F.count_if(F.col("ts").cast("timestamp") < F.current_timestamp())
    return read_table(spark, base, "events").groupBy("event_type").agg(past.alias("n_past"))


@query("f03_rand", "SELECT event_id, true AS in_range FROM events")
def rand(spark, base):
    drawn = read_table(spark, base, "events").select("event_id", F.rand(11).alias("draw"))
    return drawn.select("event_id", ((F.col("draw") >= 0) & (F.col("draw") < 1)).alias("in_range"))


@query("f04_round", "SELECT o_orderkey, round(o_totalprice / 7, 2) AS rounded FROM orders")
def round_places(spark, base):
    orders = read_table(spark, base, "orders")
    return orders.select("o_orderkey", F.round(F.col("o_totalprice") / 7, 2).alias("rounded"))


@query("f05_concat", "SELECT p_partkey, p_name || p_size AS joined FROM part")
def concat(spark, base):
    part = read_table(spark, base, "part")
    return part.select("p_partkey", F.concat("p_name", F.col("p_size").cast("string")).alias("joined"))


@query(
    "f06_concat_ws",
    "SELECT p_partkey, concat_ws('|', p_brand, CASE WHEN p_size > 25 THEN p_type END, p_size) "
    "AS joined FROM part",
)
def concat_ws(spark, base):
    kind = F.when(F.col("p_size") > 25, F.col("p_type"))
    part = read_table(spark, base, "part")
    return part.select(
        "p_partkey",
        F.concat_ws("|", "p_brand", kind, F.col("p_size").cast("string")).alias("joined"),
    )


@query(
    "f07_split_get",
    "SELECT p_partkey, string_split(p_name, ' ')[2] AS second, string_split(p_name, ' ')[9] AS ninth "
    "FROM part",
)
def split_get(spark, base):
    part = read_table(spark, base, "part")
    return part.select(
        "p_partkey",
        S.split_get(F.col("p_name"), " ", 1).alias("second"),
        S.split_get(F.col("p_name"), " ", 8).alias("ninth"),
    )


@query(
    "f08_regex_replace",
    "SELECT page_id, regexp_replace(url, '^https?://', '') AS bare FROM pages",
)
def regex_replace(spark, base):
    pages = read_table(spark, base, "pages")
    return pages.select("page_id", F.regexp_replace("url", "^https?://", "").alias("bare"))


@query("f09_string_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS size FROM documents")
def string_length(spark, base):
    return read_table(spark, base, "documents").select("doc_id", F.length("text").alias("size"))


@query(
    "f10_cast_numeric",
    "SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS number, "
    "TRY_CAST(c_name AS DOUBLE) AS failed FROM customer",
)
def cast_numeric(spark, base):
    customer = read_table(spark, base, "customer")
    digits = F.concat(F.lit(" "), F.substring("c_name", 10, 20))
    return customer.select(
        "c_custkey",
        S.cast_number(digits, "long").alias("number"),
        S.cast_number(F.col("c_name")).alias("failed"),
    )


@query(
    "f11_date_minus_days",
    "SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before FROM orders",
)
def date_minus_days(spark, base):
    orders = read_table(spark, base, "orders")
    return orders.select(
        "o_orderkey", S.days_before(F.to_date("o_orderdate"), 1).alias("day_before")
    )


@query(
    "f12_format_batch_time",
    "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS batch, "
    "count(*) AS n FROM events GROUP BY 1",
)
def format_batch_time(spark, base):
    start = F.window("ts", "1 hour")["start"]
    counted = read_table(spark, base, "events").groupBy(start.alias("start")).agg(
        F.count("*").alias("n")
    )
    return counted.select(S.format_batch_time(F.col("start")).alias("batch"), "n")


@query(
    "f13_format_number",
    "SELECT l_orderkey, l_partkey, printf('%.2f', l_extendedprice) AS price, "
    "printf('%.4f%%', l_discount * 100) AS discount FROM lineitem",
)
def format_number(spark, base):
    lines = read_table(spark, base, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_partkey",
        F.format_string("%.2f", "l_extendedprice").alias("price"),
        S.format_percent(F.col("l_discount")).alias("discount"),
    )


@query(
    "f14_sqrt_pow",
    "SELECT o_orderkey, round(sqrt(o_totalprice), 6) AS root, "
    "round(pow(o_totalprice / 1000, 2), 4) AS square FROM orders",
)
def sqrt_pow(spark, base):
    orders = read_table(spark, base, "orders")
    return orders.select(
        "o_orderkey",
        F.round(F.sqrt("o_totalprice"), 6).alias("root"),
        F.round(F.pow(F.col("o_totalprice") / 1000, F.lit(2)), 4).alias("square"),
    )


@query(
    "f15_rounding_family",
    "SELECT c_custkey, round(c_acctbal) AS rounded, CAST(ceil(c_acctbal) AS BIGINT) AS up, "
    "CAST(floor(c_acctbal) AS BIGINT) AS down, CAST(sign(c_acctbal) AS DOUBLE) AS sign, "
    "abs(c_acctbal) AS size FROM customer",
)
def rounding_family(spark, base):
    balance = F.col("c_acctbal")
    return read_table(spark, base, "customer").select(
        "c_custkey",
        F.round(balance).alias("rounded"),
        F.ceil(balance).alias("up"),
        F.floor(balance).alias("down"),
        F.signum(balance).alias("sign"),
        F.abs(balance).alias("size"),
    )


@query(
    "f16_epoch_to_timestamp",
    "SELECT event_id, date_trunc('millisecond', ts) AS from_millis, "
    "date_trunc('second', ts) AS from_seconds FROM events",
)
def epoch_to_timestamp(spark, base):
    # Reading the clock time as UTC on both ways keeps the session zone out of it.
    utc = F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    events = read_table(spark, base, "events").select(
        "event_id", F.unix_millis(utc).alias("ms"), F.unix_seconds(utc).alias("s")
    )
    def local(time):
        return F.from_utc_timestamp(time, F.current_timezone()).cast("timestamp_ntz")

    return events.select(
        "event_id",
        local(S.epoch_millis(F.col("ms"))).alias("from_millis"),
        local(S.epoch_seconds(F.col("s"))).alias("from_seconds"),
    )


@query(
    "f17_clamp_conditional",
    "SELECT event_id, greatest(round(value - 50, 2), 0) AS clamped, "
    "CASE WHEN value > 50 THEN 1 ELSE 0 END AS high FROM events",
)
def clamp_conditional(spark, base):
    events = read_table(spark, base, "events")
    return events.select(
        "event_id",
        S.clamp_low(F.round(F.col("value") - 50, 2)).alias("clamped"),
        S.threshold(F.col("value"), 50).alias("high"),
    )


@query(
    "f18_json_object_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
    "json_extract_string(props, '$.k') AS k_text, "
    "json_extract_string(props, '$.missing.city') AS city FROM events",
)
def json_object_field(spark, base):
    parsed = F.from_json("props", "k long, missing struct<city: string>")
    events = read_table(spark, base, "events").select("event_id", "props", parsed.alias("p"))
    return events.select(
        "event_id",
        F.col("p.k").alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.col("p.missing.city").alias("city"),
    )


@query(
    "f19_string_concat_suffix",
    "SELECT c_custkey, c_name || '_' || c_nationkey AS tagged FROM customer",
)
def string_concat_suffix(spark, base):
    customer = read_table(spark, base, "customer")
    return customer.select(
        "c_custkey", S.with_suffix(F.col("c_name"), F.col("c_nationkey")).alias("tagged")
    )


@query(
    "f20_array_join",
    "SELECT p_partkey, array_to_string(string_split(p_name, ' '), '+') AS joined FROM part",
)
def array_join(spark, base):
    part = read_table(spark, base, "part")
    return part.select("p_partkey", F.array_join(F.split("p_name", " "), "+").alias("joined"))


@query(
    "f21_trim",
    "SELECT c_custkey, trim('  ' || c_name || ' ') AS bare, c_nationkey AS nation FROM customer",
)
def trim(spark, base):
    customer = read_table(spark, base, "customer")
    padded = F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit("  "))
    return customer.select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("bare"),
        S.cast_number(padded, "int").alias("nation"),
    )


@query(
    "u01_udf_scalar",
    "SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS size, reverse(p_name) AS backwards FROM part",
)
def udf_scalar(spark, base):
    U.register_strlen(spark)
    U.register_arrow_function(spark, "backwards", lambda s: s.str[::-1], "string")
    return spark.sql(
        "SELECT p_partkey, strlen(p_name) AS size, backwards(p_name) AS backwards FROM {part}",
        part=read_table(spark, base, "part"),
    )


@query(
    "u02_udaf_string_count",
    I.with_tables("news_access")
    + "SELECT user_id, count(*) AS n FROM news_access GROUP BY user_id",
)
def udaf_string_count(spark, base):
    return I.news_access(spark, base).groupBy("user_id").agg(U.row_count().alias("n"))


FLAGS = ["l_returnflag", "l_linestatus"]


def _moments(frame: pd.DataFrame) -> pd.DataFrame:
    price = "l_extendedprice"
    return frame.groupby(FLAGS, as_index=False, dropna=False).agg(
        n=(price, "size"), s=(price, "sum"), low=(price, "min"), high=(price, "max")
    )


def _merge_moments(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.groupby(FLAGS, as_index=False, dropna=False).agg(
        n=("n", "sum"), s=("s", "sum"), low=("low", "min"), high=("high", "max")
    )


@query(
    "u03_udaf_custom_buffer",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, "
    "round(max(l_extendedprice) - min(l_extendedprice), 2) AS spread, "
    "round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def udaf_custom_buffer(spark, base):
    return U.custom_aggregate(
        read_table(spark, base, "lineitem"),
        FLAGS,
        ["l_extendedprice"],
        _moments,
        _merge_moments,
        "n long, s double, low double, high double",
        {
            "n": F.col("n"),
            "spread": F.round(F.col("high") - F.col("low"), 2),
            "mean": F.round(F.col("s") / F.col("n"), 4),
        },
    )
