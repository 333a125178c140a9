"""Streaming operators (T, J08) and stream reports (R10-R13).

Every query streams a whole table with ``availableNow`` and returns what reached the
sink.  Where what matters is how batches follow each other (late rows, restarts, results per
batch), the table arrives in parts and the query is restarted from its checkpoint after
each.  Socket, broker and database queries are not registered: they need a port, a
connector or a database; see ``streaming/sources.py`` and ``streaming/sinks.py``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.transforms import explode_words
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.reports import clicks, sales
from millrace.session import read_table, scratch_path
from millrace.streaming import panes, sinks, sources, state, windows
from millrace.streaming.online import OnlineLinearModels

DELAY = "10 minutes"


def _events(spark, base, delay=DELAY):
    return sources.with_event_time(sources.stream_table(spark, base, "events"), "ts", delay)


def _clicks(spark, base, delay=DELAY):
    return I.as_click_log(_events(spark, base, delay))


def _as_text(df, *times):
    """Times as text, the same in every session zone."""
    return df.withColumns({t: F.date_format(t, "yyyy-MM-dd HH:mm:ss") for t in times})


def _stamp(column, name):
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name}"


def _sliding_sql(keys, seconds, slide, aggregates, source="click_log", where="true", closed=True):
    """Sliding windows in SQL; only those the watermark has passed when ``closed``."""
    group = "".join(f", {k}" for k in keys)
    done = "WHERE w_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE" if closed else ""
    return f"""(SELECT w_start, w_start + INTERVAL {seconds} SECOND AS w_end{group}, {aggregates}
        FROM (SELECT *, time_bucket(INTERVAL {slide} SECOND, ts) - k * INTERVAL {slide} SECOND AS w_start
              FROM {source}, range({seconds // slide}) t(k) WHERE {where})
        GROUP BY w_start{group}) sliding {done}"""


ARRIVALS = 3


def _arrivals(spark, base, table, label, part):
    """The stream over a folder in which a table's parts arrive one after the other."""
    folder = scratch_path(spark, f"{label}-in")
    rows = read_table(spark, base, table)
    for k in range(ARRIVALS):
        rows.filter(F.expr(part) == k).write.mode("append").parquet(folder)
        yield sources.stream_files(spark, folder, rows.schema)


# The log by thirds of the month.
THIRD = "(dayofmonth(ts) - 1) div 11"
THIRD_SQL = "(extract(day FROM ts) - 1) // 11"

CLICK_LOG = I.with_tables("click_log")
STARTS = _stamp("w_start", "start") + ", " + _stamp("w_end", '"end"')


@query("t01_stream_source_files", "SELECT event_id, event_type, value FROM events")
def stream_source_files(spark, base):
    events = sources.stream_table(spark, base, "events").select("event_id", "event_type", "value")
    return sinks.run_append(events, scratch_path(spark, "t01"))


def _document_words(spark, base):
    return explode_words(sources.stream_table(spark, base, "documents"), "text")


WORDS_SQL = """(SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word
    FROM documents) WHERE word <> '' GROUP BY word)"""


@query("t05_stream_word_count_batch", f"SELECT word, CAST(sum(n) AS BIGINT) AS n FROM {WORDS_SQL} GROUP BY word")
def stream_word_count_batch(spark, base):
    path = scratch_path(spark, "t05")

    def count(batch, _):
        return batch.groupBy("word").agg(F.count("*").alias("n"))

    sinks.finish(sinks.per_batch(_document_words(spark, base), path, count))
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    counts = sinks.read_batches(spark, path, schema)
    # The batches' counts are independent; their sum does not depend on how files arrive.
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


@query("t06_stream_word_count_complete", f"SELECT word, n FROM {WORDS_SQL}")
def stream_word_count_complete(spark, base):
    counts = _document_words(spark, base).groupBy("word").agg(F.count("*").alias("n"))
    return sinks.run_complete(counts, scratch_path(spark, "t06"))


VISIT_STATE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("errors", T.LongType()),
    ]
)


def _fold_visits(frame: pd.DataFrame) -> pd.DataFrame:
    frame["errors"] = (frame["event_type"] == "error").astype("int64")
    grouped = frame.groupby("user_id", as_index=False, dropna=False)
    return grouped.agg(n=("value", "size"), total=("value", "sum"), errors=("errors", "sum"))


def _merge_visits(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.groupby("user_id", as_index=False, dropna=False).sum()


def _add_visits(old: tuple | None, new: pd.DataFrame) -> tuple | None:
    n, total, errors = old or (0, 0.0, 0)
    return (
        n + int(new["n"].sum()),
        total + float(new["total"].sum()),
        errors + int(new["errors"].sum()),
    )


def _forget_failing(old: tuple | None, new: pd.DataFrame) -> tuple | None:
    updated = _add_visits(old, new)
    return None if updated[2] > 15 else updated


def _user_state(spark, base, step, label):
    visits = sources.stream_table(spark, base, "events").select("user_id", "event_type", "value")
    tracked = state.update_state(
        visits,
        "user_id",
        _fold_visits,
        _merge_visits,
        "user_id long, n long, total double, errors long",
        step,
        VISIT_STATE,
    )
    latest = sinks.run_update(tracked, scratch_path(spark, label), ["user_id"])
    return latest.filter("alive").select("user_id", "n", F.round("total", 2).alias("total"))


@query(
    "t07_stream_update_state",
    "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id "
    "HAVING count(*) FILTER (WHERE event_type = 'error') <= 15",
)
def stream_update_state(spark, base):
    return _user_state(spark, base, _forget_failing, "t07")


IDLE_BATCHES = 2  # a key is forgotten after so many batches without rows
FAILURES = "event_type = 'error' AND value > 30"

IDLE_STATE = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("idle", T.LongType()), T.StructField("score", T.LongType())]
)


def _idle_sql(old, k):
    """The state after part ``k`` from the state table ``old``."""
    return f"""SELECT * FROM (SELECT coalesce(s.user_id, c.user_id) AS user_id, coalesce(s.n, 0) + coalesce(c.n, 0) AS n,
        CASE WHEN c.n IS NULL THEN s.idle + 1 ELSE 0 END AS idle,
        coalesce(s.score, 0) // 2 + coalesce(c.n, 0) AS score
        FROM {old} s FULL JOIN (SELECT * FROM failures WHERE k = {k}) c ON s.user_id IS NOT DISTINCT FROM c.user_id)
        WHERE idle < {IDLE_BATCHES}"""


@query(
    "t07_stream_update_every_key",
    f"""WITH failures AS (SELECT user_id, {THIRD_SQL} AS k, count(*) AS n FROM events WHERE {FAILURES} GROUP BY ALL),
        none AS (SELECT * FROM (SELECT user_id, n, 0::BIGINT AS idle, n AS score FROM failures) WHERE false),
        first AS ({_idle_sql('none', 0)}), second AS ({_idle_sql('first', 1)}), third AS ({_idle_sql('second', 2)})
        SELECT 0::BIGINT AS batch, user_id, n, idle::BIGINT AS idle, score FROM first
        UNION ALL SELECT 1, * FROM second UNION ALL SELECT 2, * FROM third""",
)
def stream_update_every_key(spark, base):
    """Serious errors per user: a score halves with every batch, also for users without new ones."""
    path = scratch_path(spark, "t07-every")
    count = F.coalesce(F.col("new.n"), F.lit(0))
    for stream in _arrivals(spark, base, "events", "t07-every", THIRD):
        query = state.update_every_key(
            stream.filter(FAILURES).select("user_id"),
            path,
            ["user_id"],
            {"n": F.count("*")},
            {
                "n": F.coalesce(F.col("old.n"), F.lit(0)) + count,
                "idle": F.when(F.col("new").isNull(), F.col("old.idle") + 1).otherwise(0),
                "score": F.floor(F.coalesce(F.col("old.score"), F.lit(0)) / 2) + count,
            },
            IDLE_STATE,
            keep=F.col("idle") < IDLE_BATCHES,
        )
        sinks.finish(query)
    user = T.StructField("user_id", T.LongType())
    return sinks.read_batches(spark, path, T.StructType([user, *IDLE_STATE.fields]))


PURCHASES_SQL = (
    CLICK_LOG
    + "SELECT user_id, count(*) AS purchases, round(sum(value), 2) AS revenue FROM click_log "
    "WHERE category = 'purchase' GROUP BY user_id"
)


@query("t08_stream_state_tuple", PURCHASES_SQL)
def stream_state_tuple(spark, base):
    bought = clicks.purchases(_clicks(spark, base, None))
    running = bought.groupBy("user_id").agg(
        F.count("*").alias("purchases"), F.sum("price").alias("revenue")
    )
    latest = sinks.run_update(running, scratch_path(spark, "t08"), ["user_id"])
    return latest.withColumn("revenue", F.round("revenue", 2))


@query(
    "t08_stream_state_tuple_general",
    "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id",
)
def stream_state_tuple_general(spark, base):
    return _user_state(spark, base, _add_visits, "t08-general")


@query(
    "t09_stream_sliding_count",
    CLICK_LOG + f"SELECT {STARTS}, category, n FROM "
    + _sliding_sql(["category"], 60, 10, "count(*) AS n"),
)
def stream_sliding_count(spark, base):
    log, path = _clicks(spark, base), scratch_path(spark, "t09")
    counts = panes.run_windows(log, path, "ts", "60 seconds", "10 seconds", ["category"], panes.count_rows())
    return _as_text(counts, "start", "end")


@query(
    "t10_stream_event_window",
    CLICK_LOG + f"SELECT {STARTS}, product, n FROM "
    + _sliding_sql(["product"], 600, 300, "count(*) AS n"),
)
def stream_event_window(spark, base):
    log, path = _clicks(spark, base), scratch_path(spark, "t10")
    counts = panes.run_windows(log, path, "ts", "10 minutes", "5 minutes", ["product"], panes.count_rows())
    return _as_text(counts, "start", "end")


# Every fiftieth row arrives a third of a month late, mostly behind the watermark.
LATE = "least((dayofmonth(ts) - 1) div 11 + if(event_id % 50 = 0, 1, 0), 2)"


@query(
    "t11_stream_watermark_late",
    CLICK_LOG
    + f""", arrived AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS w_start,
              least({THIRD_SQL} + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END, 2) AS k FROM click_log),
         marks AS (SELECT b.k, max(a.ts) - INTERVAL 10 MINUTE AS mark
              FROM arrived a JOIN (SELECT unnest([1, 2, 3]) AS k) b ON a.k < b.k GROUP BY b.k)
         SELECT {_stamp('w_start', 'start')}, {_stamp('w_start + INTERVAL 1 HOUR', '"end"')}, category,
              count(*) AS n, round(sum(value), 2) AS total
         FROM arrived a LEFT JOIN marks m ON m.k = a.k
         WHERE (mark IS NULL OR w_start + INTERVAL 1 HOUR > mark)
           AND w_start + INTERVAL 1 HOUR <= (SELECT mark FROM marks WHERE k = 3)
         GROUP BY w_start, category""",
)
def stream_watermark_late(spark, base):
    path = scratch_path(spark, "t11")
    for stream in _arrivals(spark, base, "events", "t11", LATE):
        clicks_so_far = I.as_click_log(sources.with_event_time(stream, "ts", DELAY))
        hourly = windows.window_aggregate(
            clicks_so_far, "ts", "1 hour", None, "category", n=F.count("*"), total=F.sum("value")
        )
        closed = sinks.run_append(hourly, path)
    return _as_text(closed, "start", "end").withColumn("total", F.round("total", 2))


@query(
    "t12_stream_transform",
    I.with_tables("blacklist")
    + "SELECT event_type, count(*) AS n FROM events WHERE user_id NOT IN "
    "(SELECT user_id FROM blacklist WHERE flag) GROUP BY event_type",
)
def stream_transform(spark, base):
    flagged = I.blacklist(spark, base)
    path = scratch_path(spark, "t12")

    def clean(batch, _):
        kept = clicks.valid_clicks(batch, flagged)
        return kept.groupBy("event_type").agg(F.count("*").alias("n"))

    events = sources.stream_table(spark, base, "events").select("user_id", "event_type")
    sinks.finish(sinks.per_batch(events, path, clean))
    schema = T.StructType(
        [T.StructField("event_type", T.StringType()), T.StructField("n", T.LongType())]
    )
    counts = sinks.read_batches(spark, path, schema)
    return counts.groupBy("event_type").agg(F.sum("n").alias("n"))


@query(
    "t13_stream_foreach_batch_sql",
    CLICK_LOG
    + "SELECT start, category, product, n FROM (SELECT *, row_number() OVER "
    "(PARTITION BY start, category ORDER BY n DESC, product) AS rn FROM "
    f"(SELECT {_stamp('w_start', 'start')}, category, product, n FROM "
    + _sliding_sql(["category", "product"], 21600, 21600, "count(*) AS n")
    + ")) WHERE rn <= 3",
)
def stream_foreach_batch_sql(spark, base):
    path = scratch_path(spark, "t13")
    counts = windows.window_aggregate(
        _clicks(spark, base), "ts", "6 hours", None, "category", "product", n=F.count("*")
    )

    def top3(batch, _):
        return batch.sparkSession.sql(
            "SELECT date_format(start, 'yyyy-MM-dd HH:mm:ss') AS start, category, product, n FROM "
            "(SELECT *, row_number() OVER (PARTITION BY start, category ORDER BY n DESC, product) "
            "AS rn FROM {counts}) WHERE rn <= 3",
            counts=batch,
        )

    sinks.finish(sinks.per_batch(counts, path, top3))
    schema = T.StructType(
        [
            T.StructField("start", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("product", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )
    return sinks.read_batches(spark, path, schema).drop("batch")


METRICS = T.StructType(
    [
        T.StructField("purchases", T.LongType()),
        T.StructField("users", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("top_product", T.LongType()),
        T.StructField("top_purchases", T.LongType()),
    ]
)


def _metrics_per_batch(streams, path, spark):
    for stream in streams:
        bought = clicks.purchases(I.as_click_log(stream))
        sinks.finish(sinks.per_batch(bought, path, lambda batch, _: sales.batch_metrics(batch)))
    return sinks.read_batches(spark, path, METRICS).withColumn("revenue", F.round("revenue", 2))


@query(
    "t14_stream_batch_metrics",
    CLICK_LOG
    + f""", p AS (SELECT *, {THIRD_SQL} AS batch FROM click_log WHERE category = 'purchase'),
         best AS (SELECT batch, product, count(*) AS n FROM p GROUP BY batch, product
              QUALIFY row_number() OVER (PARTITION BY batch ORDER BY n DESC, product) = 1)
         SELECT p.batch, count(*) AS purchases, count(DISTINCT user_id) AS users, round(sum(value), 2) AS revenue,
              any_value(best.product) AS top_product, any_value(best.n) AS top_purchases
         FROM p JOIN best ON best.batch = p.batch GROUP BY p.batch""",
)
def stream_batch_metrics(spark, base):
    streams = _arrivals(spark, base, "events", "t14", THIRD)
    return _metrics_per_batch(streams, scratch_path(spark, "t14"), spark)


@query("t16_stream_sink_files", 
    "SELECT event_id, event_type, value, kind FROM events, (VALUES ('json'), ('orc'), ('csv')) t(kind)",
)
def stream_sink_files(spark, base):
    events = sources.stream_table(spark, base, "events").select("event_id", "event_type", "value")
    path = scratch_path(spark, "t16")
    for kind in ("json", "orc", "csv"):
        sinks.finish(sinks.to_files(events, f"{path}/{kind}", source=kind))
    read = spark.read.schema(events.schema)
    parts = [
        read.format(kind).load(f"{path}/{kind}").withColumn("kind", F.lit(kind))
        for kind in ("json", "orc", "csv")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("t17_stream_sink_foreach", "SELECT event_id, event_type, value FROM events")
def stream_sink_foreach(spark, base):
    events = sources.stream_table(spark, base, "events").select("event_id", "event_type", "value")
    path = scratch_path(spark, "t17")
    sinks.finish(sinks.to_foreach(events, path))
    return spark.read.schema(events.schema).json(f"{path}/batch=*")


@query(
    "t18_stream_sink_memory_console",
    "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
)
def stream_sink_memory_console(spark, base):
    counts = (
        sources.stream_table(spark, base, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    )
    path = scratch_path(spark, "t18")
    name = "memory_" + path.rsplit("-", 1)[1]
    sinks.finish(sinks.to_memory(counts, name, path))
    sinks.finish(sinks.to_console(counts, f"{path}-console", mode="complete"))
    return spark.table(name)


@query(
    "t19_stream_output_modes",
    CLICK_LOG
    + f"SELECT 'append' AS mode, {_stamp('w_start', 'start')}, n FROM "
    + _sliding_sql([], 86400, 86400, "count(*) AS n")
    + f" UNION ALL SELECT m, {_stamp('w_start', 'start')}, n FROM (VALUES ('update'), ('complete')) v(m), "
    + _sliding_sql([], 86400, 86400, "count(*) AS n", closed=False),
)
def stream_output_modes(spark, base):
    def daily():
        return windows.window_aggregate(_clicks(spark, base), "ts", "1 day", None, n=F.count("*"))

    results = {
        "append": sinks.run_append(daily(), scratch_path(spark, "t19-append")),
        "update": sinks.run_update(daily(), scratch_path(spark, "t19-update"), ["start", "end"]),
        "complete": sinks.run_complete(daily(), scratch_path(spark, "t19-complete")),
    }
    parts = [
        _as_text(df, "start").select(F.lit(mode).alias("mode"), "start", "n")
        for mode, df in results.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "t20_stream_ops_lifted",
    CLICK_LOG
    + f", short AS (SELECT w_start, n FROM {_sliding_sql([], 600, 600, 'count(*) AS n', closed=False)})"
    + f"""SELECT {_stamp('h', 'start')}, max(n) AS peak, CAST(sum(n) AS BIGINT) AS total FROM
         (SELECT time_bucket(INTERVAL 6 HOUR, w_start) AS h, n FROM short) GROUP BY h
         HAVING h + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_ops_lifted(spark, base):
    peaks = windows.chained_peak(_events(spark, base), "ts", "10 minutes", "6 hours")
    closed = sinks.run_append(peaks, scratch_path(spark, "t20"))
    return _as_text(closed, "start").drop("end")


@query(
    "t20_stream_distinct",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def stream_distinct(spark, base):
    pairs = sources.stream_table(spark, base, "events").select("user_id", "event_type")
    return sinks.run_append(state.distinct_rows(pairs), scratch_path(spark, "t20-distinct"))


@query(
    "t20_stream_join",
    "SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM orders JOIN lineitem "
    "ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 121 DAY",
)
def stream_join(spark, base):
    orders = sources.with_event_time(
        sources.stream_table(spark, base, "orders").select("o_orderkey", "o_orderdate"),
        "o_orderdate",
        "1 day",
    )
    lines = sources.with_event_time(
        sources.stream_table(spark, base, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
        ),
        "l_shipdate",
        "1 day",
    )
    joined = windows.join_within(
        orders, lines, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate", "121 days"
    )
    columns = ("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return sinks.run_append(joined.select(*columns), scratch_path(spark, "t20-join"), idle=False)


SPAN = 6  # hours


@query(
    "t20_stream_left_join",
    f"""WITH mark AS (SELECT least(max(ts) FILTER (WHERE event_type = 'view'),
              max(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 10 MINUTE AS t FROM events),
         matched AS (SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.ts FROM events v
              LEFT JOIN events p ON p.user_id = v.user_id AND p.event_type = 'purchase'
              AND p.ts BETWEEN v.ts AND v.ts + INTERVAL {SPAN} HOUR WHERE v.event_type = 'view')
         SELECT view_id, purchase_id FROM matched, mark
         WHERE purchase_id IS NOT NULL OR ts + INTERVAL {SPAN} HOUR < mark.t""",
)
def stream_left_join(spark, base):
    """Views with the purchases that follow within hours; those without one once the watermark has passed."""

    def of_kind(kind, name):
        rows = _events(spark, base).filter(F.col("event_type") == kind)
        return rows.select(F.col("event_id").alias(f"{name}_id"), F.col("user_id").alias(f"{name}_user"), F.col("ts").alias(f"{name}_ts"))

    joined = windows.join_within(
        of_kind("view", "view"), of_kind("purchase", "purchase"), "view_user", "purchase_user", "view_ts", "purchase_ts",
        f"{SPAN} hours", how="left",
    )
    return sinks.run_append(joined.select("view_id", "purchase_id"), scratch_path(spark, "t20-left"))


FIRST_ROWS = 100


@query(
    "t20_stream_limit",
    f"SELECT least(count(*), {FIRST_ROWS}) AS n, least(count(*), {FIRST_ROWS}) AS known FROM events",
)
def stream_limit(spark, base):
    """A limit counts over all batches; which rows come first is the source's choice."""
    path = scratch_path(spark, "t20-limit")
    for stream in _arrivals(spark, base, "events", "t20-limit", THIRD):
        first = sinks.run_append(stream.select("event_id").limit(FIRST_ROWS), path)
    known = read_table(spark, base, "events").select("event_id", F.lit(1).alias("known"))
    return first.join(known, "event_id", "left").agg(F.count("*").alias("n"), F.count("known").alias("known"))


@query(
    "t20_stream_sort_limit",
    "SELECT user_id, n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ORDER BY n DESC, user_id LIMIT 10",
)
def stream_sort_limit(spark, base):
    """The ten busiest users so far, after each of three batches; the last result counts."""
    path = scratch_path(spark, "t20-sort")
    for stream in _arrivals(spark, base, "events", "t20-sort", THIRD):
        counts = stream.groupBy("user_id").agg(F.count("*").alias("n"))
        busiest = sinks.run_complete(counts.orderBy(F.desc("n"), "user_id").limit(10), path)
    return busiest


@query("t21_stream_checkpoint_restart", PURCHASES_SQL)
def stream_checkpoint_restart(spark, base):
    path = scratch_path(spark, "t21")
    # Each run resumes from the checkpoint of the one before and finds new input.
    for stream in _arrivals(spark, base, "events", "t21", THIRD):
        bought = clicks.purchases(I.as_click_log(stream))
        running = bought.groupBy("user_id").agg(
            F.count("*").alias("purchases"), F.sum("price").alias("revenue")
        )
        latest = sinks.run_update(running, path, ["user_id"])
    return latest.withColumn("revenue", F.round("revenue", 2))


@query("t22_stream_trigger", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_trigger(spark, base):
    path = scratch_path(spark, "t22")
    counts = (
        sources.stream_table(spark, base, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    )
    running = sinks.per_batch(
        counts, path, mode="complete", trigger={"processingTime": "200 milliseconds"}
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return sinks.latest_complete(spark, path, counts.schema)


@query("t23_stream_query_manage", "SELECT count(*) AS input_rows, true AS ended FROM events")
def stream_query_manage(spark, base):
    events = sources.stream_table(spark, base, "events").select("event_id")
    with sinks.ProgressLog(spark) as log:
        done = sinks.finish(sinks.to_files(events, scratch_path(spark, "t23")))
        progress = log.frame(done)
    ended = done.exception() is None and not done.isActive
    return progress.agg(F.sum("input_rows").alias("input_rows"), F.lit(ended).alias("ended"))


@query(
    "t24_stream_filter_select_group",
    "SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events WHERE value > 10 "
    "GROUP BY event_type",
)
def stream_filter_select_group(spark, base):
    strong = sources.stream_table(spark, base, "events").where("value > 10")
    counts = strong.groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    latest = sinks.run_complete(counts, scratch_path(spark, "t24"))
    return latest.withColumn("mean", F.round("mean", 4))


def _priced_lines(spark, base, lines=None):
    lines = sources.stream_table(spark, base, "lineitem") if lines is None else lines
    return lines.select(
        "l_orderkey",
        "l_partkey",
        (F.col("l_extendedprice") / 100000).alias("label"),
        F.array(F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10).alias(
            "features"
        ),
    )


ONLINE_SQL = """WITH x AS (SELECT l_orderkey, l_partkey, l_extendedprice / 100000 AS y, l_quantity / 50 AS a,
    l_discount * 10 AS b, l_tax * 10 AS c FROM lineitem),
    w AS (SELECT avg(y * a) AS wa, avg(y * b) AS wb, avg(y * c) AS wc FROM x) """


@query(
    "t25_stream_train_predict",
    ONLINE_SQL + "SELECT l_orderkey, l_partkey, "
    "round(0.1 * (wa * a + wb * b + wc * c), 6) AS prediction FROM x, w",
)
def stream_train_predict(spark, base):
    models = OnlineLinearModels(scratch_path(spark, "t25"), {"prediction": 0.1}, width=3)
    sinks.finish(models.train_on(_priced_lines(spark, base), keep=["l_orderkey", "l_partkey"]))
    scored = models.results(spark, "predictions")
    return scored.select("l_orderkey", "l_partkey", F.round("prediction", 6).alias("prediction"))


def _error_sql(weights):
    """The mean squared error of weights from a batch's second moments."""
    a, b, c = weights
    return f"""yy - 2 * ({a} * ya + {b} * yb + {c} * yc) + {a} * {a} * aa + {b} * {b} * bb + {c} * {c} * cc
        + 2 * ({a} * {b} * ab + {a} * {c} * ac + {b} * {c} * bc)"""


# Gradient descent over three batches, in SQL: the moments of each batch, then weights and errors in turn.
DESCENT_SQL = f"""WITH x AS (SELECT l_orderkey % 3 AS k, l_extendedprice / 100000 AS y, l_quantity / 50 AS a,
        l_discount * 10 AS b, l_tax * 10 AS c FROM lineitem),
    m AS (SELECT k, avg(y * y) AS yy, avg(y * a) AS ya, avg(y * b) AS yb, avg(y * c) AS yc, avg(a * a) AS aa,
        avg(b * b) AS bb, avg(c * c) AS cc, avg(a * b) AS ab, avg(a * c) AS ac, avg(b * c) AS bc FROM x GROUP BY k),
    models(model, step) AS (VALUES ('small_step', 0.01::DOUBLE), ('large_step', 0.5::DOUBLE)),
    first AS (SELECT model, step, yy AS e0, step * ya AS wa, step * yb AS wb, step * yc AS wc FROM models, m WHERE k = 0),
    second AS (SELECT model, e0, {_error_sql(("wa", "wb", "wc"))} AS e1,
        wa - step * (aa * wa + ab * wb + ac * wc - ya) AS va, wb - step * (ab * wa + bb * wb + bc * wc - yb) AS vb,
        wc - step * (ac * wa + bc * wb + cc * wc - yc) AS vc FROM first, m WHERE k = 1),
    third AS (SELECT model, e0, e1, {_error_sql(("va", "vb", "vc"))} AS e2 FROM second, m WHERE k = 2)
    SELECT model, batch, round(e, 6) AS mse, round(sqrt(e), 6) AS rmse
    FROM (SELECT model, unnest([0, 1, 2])::BIGINT AS batch, unnest([e0, e1, e2]) AS e FROM third)"""


@query("t26_stream_compare_models", DESCENT_SQL)
def stream_compare_models(spark, base):
    """The error of two models that differ in step size, batch by batch, before they learn from it."""
    models = OnlineLinearModels(scratch_path(spark, "t26"), {"small_step": 0.01, "large_step": 0.5}, width=3)
    for lines in _arrivals(spark, base, "lineitem", "t26", "l_orderkey % 3"):
        sinks.finish(models.train_on(_priced_lines(spark, base, lines)))
    errors = models.results(spark, "errors")
    return errors.select(
        "model", F.col("batch").cast("long").alias("batch"), F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse")
    )


@query(
    "t27_stream_cache",
    "SELECT 'type' AS kind, event_type AS key, count(*) AS n FROM events GROUP BY event_type UNION ALL "
    "SELECT 'user', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY user_id",
)
def stream_cache(spark, base):
    path = scratch_path(spark, "t27")

    def two_outputs(batch, batch_id):
        rows = batch.persist()
        try:
            for kind, column in (("type", "event_type"), ("user", "user_id")):
                counts = rows.groupBy(F.col(column).cast("string").alias("key")).agg(
                    F.count("*").alias("n")
                )
                counts.write.mode("overwrite").parquet(f"{path}/kind={kind}/batch={batch_id}")
        finally:
            rows.unpersist()

    events = sources.stream_table(spark, base, "events").select("event_type", "user_id")
    sinks.finish(sinks.per_batch(events, path, two_outputs))
    written = spark.read.schema("key string, n long, kind string, batch long").parquet(path)
    return written.groupBy("kind", "key").agg(F.sum("n").alias("n"))


@query(
    "t28_stream_union",
    "SELECT kind, count(*) AS n, CAST(sum(key) AS BIGINT) AS total FROM (SELECT 'order' AS kind, "
    "o_orderkey AS key FROM orders UNION ALL SELECT 'event', event_id FROM events) GROUP BY kind",
)
def stream_union(spark, base):
    orders = sources.stream_table(spark, base, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("key")
    )
    events = sources.stream_table(spark, base, "events").select(
        F.lit("event").alias("kind"), F.col("event_id").alias("key")
    )
    merged = orders.unionByName(events)
    totals = merged.groupBy("kind").agg(F.count("*").alias("n"), F.sum("key").alias("total"))
    return sinks.run_complete(totals, scratch_path(spark, "t28"))


@query(
    "t29_stream_window_total",
    CLICK_LOG + f"SELECT {STARTS}, total FROM "
    + _sliding_sql([], 60, 10, "round(sum(value), 2) AS total"),
)
def stream_window_total(spark, base):
    total = {"total": (F.sum("value"), F.sum("total"))}
    closed = panes.run_windows(
        _clicks(spark, base), scratch_path(spark, "t29"), "ts", "60 seconds", "10 seconds", [], total
    )
    return _as_text(closed, "start", "end").withColumn("total", F.round("total", 2))


@query(
    "j08_join_stream_static",
    "SELECT event_id, 'inner' AS how, c_mktsegment AS segment FROM events JOIN customer "
    "ON user_id = c_custkey AND c_acctbal > 0 UNION ALL SELECT event_id, 'outer', c_mktsegment "
    "FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0",
)
def join_stream_static(spark, base):
    customer = read_table(spark, base, "customer").filter("c_acctbal > 0")
    static = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    parts = []
    for how in ("inner", "outer"):
        events = sources.stream_table(spark, base, "events").select("event_id", "user_id")
        joined = windows.join_static(events, static, "user_id", "inner" if how == "inner" else "left")
        rows = joined.select("event_id", F.lit(how).alias("how"), "segment")
        parts.append(sinks.run_append(rows, scratch_path(spark, f"j08-{how}")))
    return parts[0].unionByName(parts[1])


@query(
    "r10_hot_words_sliding",
    CLICK_LOG
    + "SELECT start, word, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY start ORDER BY n DESC, word) AS rank FROM "
    f"(SELECT {_stamp('w_start', 'start')}, category AS word, n FROM "
    + _sliding_sql(["category"], 60, 10, "count(*) AS n")
    + ")) WHERE rank <= 3",
)
def hot_words_sliding(spark, base):
    searches = _clicks(spark, base).withColumnRenamed("category", "word")
    path = scratch_path(spark, "r10")
    sinks.finish(
        panes.per_window(
            searches, path, "ts", "60 seconds", "10 seconds", ["word"], panes.count_rows(),
            lambda counts, _: clicks.hot_words(counts), together=[],
        )
    )
    counts = clicks.search_word_counts(searches)
    schema = T.StructType([*counts.schema.fields, T.StructField("rank", T.IntegerType())])
    return _as_text(sinks.read_batches(spark, path, schema).drop("batch", "end"), "start")


@query(
    "r11_top3_hot_product",
    CLICK_LOG
    + "SELECT start, category, product, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() "
    "OVER (PARTITION BY start, category ORDER BY n DESC, product) AS rank FROM "
    f"(SELECT {_stamp('w_start', 'start')}, category, product, n FROM "
    + _sliding_sql(["category", "product"], 60, 10, "count(*) AS n")
    + ")) WHERE rank <= 3",
)
def top3_hot_product(spark, base):
    log, path = _clicks(spark, base), scratch_path(spark, "r11")
    sinks.finish(
        panes.per_window(
            log, path, "ts", "60 seconds", "10 seconds", ["category", "product"], panes.count_rows(),
            lambda counts, _: clicks.hot_products(counts), together=["category"],
        )
    )
    counts = clicks.product_click_counts(log)
    schema = T.StructType([*counts.schema.fields, T.StructField("rank", T.IntegerType())])
    return _as_text(sinks.read_batches(spark, path, schema).drop("batch", "end"), "start")


@query(
    "r12_valid_ad_clicks",
    I.with_tables("blacklist")
    + "SELECT event_id, user_id FROM events WHERE event_type = 'click' "
    "AND user_id NOT IN (SELECT user_id FROM blacklist WHERE flag)",
)
def valid_ad_clicks(spark, base):
    ads = sources.stream_table(spark, base, "events").filter("event_type = 'click'")
    valid = clicks.valid_clicks(ads.select("event_id", "user_id"), I.blacklist(spark, base))
    return sinks.run_append(valid, scratch_path(spark, "r12"))


@query(
    "r13_session_metrics_batch",
    CLICK_LOG
    + ", p AS (SELECT * FROM click_log WHERE category = 'purchase') SELECT 0::BIGINT AS batch, "
    "count(*) AS purchases, count(DISTINCT user_id) AS users, round(sum(value), 2) AS revenue, "
    "(SELECT product FROM p GROUP BY product ORDER BY count(*) DESC, product LIMIT 1) AS top_product, "
    "(SELECT count(*) FROM p GROUP BY product ORDER BY count(*) DESC, product LIMIT 1) AS top_purchases "
    "FROM p",
)
def session_metrics_batch(spark, base):
    return _metrics_per_batch([_events(spark, base, None)], scratch_path(spark, "r13"), spark)
