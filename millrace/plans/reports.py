"""Batch reports (R01-R09, R14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.transforms import explode_words
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.reports import news, sales, staff
from millrace.session import read_table, scratch_path
from millrace.sources import tables

NEWS = I.with_tables("news_access")


@query(
    "r01_news_daily_page_pv",
    NEWS + "SELECT date, page_id, count(*) AS pv FROM news_access WHERE action = 'view' "
    "GROUP BY date, page_id",
)
def news_daily_page_pv(spark, base):
    return news.daily_page_pv(I.news_access(spark, base))


@query(
    "r02_news_daily_page_uv",
    NEWS + "SELECT date, page_id, count(*) AS uv FROM (SELECT DISTINCT date, page_id, user_id "
    "FROM news_access WHERE action = 'view') GROUP BY date, page_id",
)
def news_daily_page_uv(spark, base):
    return news.daily_page_uv(I.news_access(spark, base))


@query(
    "r03_news_register_rate",
    NEWS + "SELECT date, registrations, anonymous_views, "
    "round(registrations / nullif(anonymous_views, 0), 2) AS rate FROM "
    "(SELECT date, count(*) FILTER (WHERE action = 'signup') AS registrations, "
    "count(*) FILTER (WHERE action = 'view' AND user_id IS NULL) AS anonymous_views "
    "FROM news_access GROUP BY date)",
)
def news_register_rate(spark, base):
    return news.register_rate(I.news_access(spark, base), register="signup")


@query(
    "r04_news_jump_rate",
    NEWS + "SELECT date, count(*) FILTER (WHERE n = 1) AS jumps, CAST(sum(n) AS BIGINT) AS views, "
    "round(count(*) FILTER (WHERE n = 1) / sum(n), 2) AS rate FROM "
    "(SELECT date, user_id, count(*) AS n FROM news_access WHERE action = 'view' "
    "AND user_id IS NOT NULL GROUP BY date, user_id) GROUP BY date",
)
def news_jump_rate(spark, base):
    return news.jump_rate(I.news_access(spark, base))


@query(
    "r05_news_section_pv_rank",
    NEWS + "SELECT date, section, count(*) AS pv FROM news_access WHERE action = 'view' "
    "GROUP BY date, section",
)
def news_section_pv_rank(spark, base):
    return news.section_pv_rank(I.news_access(spark, base))


@query(
    "r06_department_stats",
    I.with_tables("employee", "department")
    + "SELECT dep_name, gender, round(avg(salary), 4) AS mean_salary, round(avg(age), 4) AS mean_age "
    "FROM employee JOIN department ON dep_id = id WHERE age > 20 GROUP BY dep_name, gender",
)
def department_stats(spark, base):
    found = staff.department_stats(I.employee(spark, base), I.department(spark, base))
    return found.withColumns({n: F.round(n, 4) for n in ("mean_salary", "mean_age")})


@query(
    "r07_daily_uv",
    NEWS + "SELECT date, count(DISTINCT user_id) AS uv FROM news_access GROUP BY date",
)
def daily_uv(spark, base):
    return news.daily_uv(I.news_access(spark, base))


@query(
    "r08_good_students",
    I.with_tables("employee")
    + "SELECT c_name AS name, age, c_acctbal AS score FROM customer JOIN employee ON name = c_name "
    "WHERE c_acctbal >= 8000",
)
def good_students(spark, base):
    infos = I.employee(spark, base).select("name", "age")
    scores = read_table(spark, base, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("score")
    )
    target = scratch_path(spark, "good-students")
    return tables.table_save_read(
        staff.good_students(infos, scores, 8000),
        "millrace_" + target.rsplit("-", 1)[1],
        location=target,
    )


@query(
    "r09_daily_top3_keyword",
    I.with_tables("news_access")
    + """SELECT date, word, n_users, CAST(rank AS INTEGER) AS rank FROM (SELECT date, word, n_users,
           row_number() OVER (PARTITION BY date ORDER BY n_users DESC, word) AS rank FROM
           (SELECT date, section AS word, count(DISTINCT user_id) AS n_users FROM news_access
            GROUP BY date, section)) WHERE rank <= 3""",
)
def daily_top3_keyword(spark, base):
    log = I.news_access(spark, base)
    return news.daily_top_keywords(log.select("date", F.col("section").alias("word"), "user_id"))


@query(
    "r09_top3_keyword_text",
    """SELECT conv_id AS date, word, n_users, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number()
       OVER (PARTITION BY conv_id ORDER BY n_users DESC, word) AS rank FROM
       (SELECT conv_id, word, count(DISTINCT turn) AS n_users FROM (SELECT conv_id, turn,
        unnest(string_split(text, ' ')) AS word FROM conversations) WHERE word <> ''
        GROUP BY conv_id, word)) WHERE rank <= 3""",
)
def top3_keyword_text(spark, base):
    said = explode_words(read_table(spark, base, "conversations"), "text", "conv_id", "turn")
    return news.daily_top_keywords(said.toDF("date", "user_id", "word"))


@query(
    "r14_top_product_sales",
    I.with_tables("product_sales")
    + "SELECT product, category, revenue, CAST(rank AS INTEGER) AS rank FROM "
    "(SELECT *, row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product) AS rank "
    "FROM product_sales) WHERE rank <= 3",
)
def top_product_sales(spark, base):
    return sales.top_products(I.product_sales(spark, base))
