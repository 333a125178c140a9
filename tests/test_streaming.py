"""Streams: equal to the batch answer, restartable, and bounded by watermarks."""

import json
import sys
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.reports import clicks
from millrace.sources.jdbc import Database
from millrace.streaming import online, sinks, sources, state, windows
from millrace.streaming.online import OnlineLinearModels

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "ts timestamp, user_id long, word string, value double"
START = datetime(2024, 1, 1)


def make_rows(n, seed=1):
    rng = np.random.default_rng(seed)
    seconds = np.sort(rng.integers(0, 600, n))
    return [
        (START + timedelta(seconds=int(s)), int(rng.integers(0, 5)), "abcd"[int(rng.integers(0, 4))],
         float(rng.integers(0, 100)))
        for s in seconds
    ]


def write_file(spark, rows, folder, name):
    """One Parquet file per call, with increasing modification times."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")
    time.sleep(0.02)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """A log range-split by time into four files."""
    folder = str(tmp_path_factory.mktemp("log"))
    rows = make_rows(200)
    for i in range(4):
        write_file(spark, rows[i * 50:(i + 1) * 50], folder, f"f{i}")
    return folder, spark.createDataFrame(rows, SCHEMA)


def read(spark, folder, per_trigger=1):
    return sources.stream_files(spark, f"{folder}/f*", SCHEMA, max_files=per_trigger)


def test_running_counts_equal_batch(spark, log, tmp_path, collected):
    folder, table = log
    def count(df):
        return df.groupBy("word").agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    expected = collected(count(table))
    assert collected(sinks.run_complete(count(read(spark, folder)), str(tmp_path / "c"))) == expected
    assert collected(sinks.run_update(count(read(spark, folder)), str(tmp_path / "u"), ["word"])) == expected


def test_closed_windows_equal_batch(spark, log, tmp_path, collected):
    folder, table = log
    timed = sources.with_event_time(read(spark, folder), "ts", "30 seconds")
    streamed = sinks.run_append(windows.sliding_count(timed, "ts", "word"), str(tmp_path / "w"))
    last = table.agg(F.max("ts")).first()[0]
    closed = windows.sliding_count(table, "ts", "word").filter(
        F.col("end") <= F.lit(last) - F.expr("INTERVAL 30 SECONDS")
    )
    assert collected(streamed) == collected(closed)
    assert streamed.filter("n = 0").count() == 0


def test_top_words_per_window_equal_batch(spark, log, tmp_path, collected):
    folder, table = log
    timed = sources.with_event_time(read(spark, folder), "ts", "10 seconds")
    path = str(tmp_path / "top")
    counts = clicks.search_word_counts(timed)
    sinks.finish(sinks.per_batch(counts, path, lambda batch, _: clicks.hot_words(batch)))
    schema = T.StructType([*counts.schema.fields, T.StructField("rank", T.IntegerType())])
    got = sinks.read_batches(spark, path, schema).drop("batch")
    last = table.agg(F.max("ts")).first()[0]
    closed = clicks.search_word_counts(table).filter(
        F.col("end") <= F.lit(last) - F.expr("INTERVAL 10 SECONDS")
    )
    assert collected(got) == collected(clicks.hot_words(closed))


def test_late_rows_are_dropped_only_beyond_the_watermark(spark, tmp_path, collected):
    folder = str(tmp_path / "late")
    at = lambda s: START + timedelta(seconds=s)
    write_file(spark, [(at(5), 1, "a", 1.0), (at(100), 1, "a", 1.0)], folder, "f0")
    write_file(spark, [(at(80), 1, "a", 1.0)], folder, "f1")  # behind, within the delay
    write_file(spark, [(at(7), 1, "a", 1.0), (at(300), 1, "a", 1.0)], folder, "f2")  # far behind
    timed = sources.with_event_time(read(spark, folder), "ts", "30 seconds")
    counts = windows.window_aggregate(timed, "ts", "1 minute", None, n=F.count("*"))
    got = sinks.run_append(counts, str(tmp_path / "out"))
    assert [n for *_, n in collected(got)] == [1, 2]


def test_restart_from_checkpoint_equals_one_run(spark, log, tmp_path, collected):
    _, table = log
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [tuple(r) for r in table.orderBy("ts").collect()]
    def run():
        counts = read(spark, folder, 2).groupBy("user_id").agg(F.count("*").alias("n"))
        return sinks.run_update(counts, path, ["user_id"])
    for i in range(2):
        write_file(spark, rows[i * 50:(i + 1) * 50], folder, f"f{i}")
    run()
    for i in range(2, 4):
        write_file(spark, rows[i * 50:(i + 1) * 50], folder, f"f{i}")
    assert collected(run()) == collected(table.groupBy("user_id").count())
    assert collected(run()) == collected(table.groupBy("user_id").count())  # nothing new: no change


STATE = T.StructType([T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())])


def fold(frame):
    return frame.groupby("user_id", as_index=False).agg(n=("value", "size"), total=("value", "sum"))


def merge(frame):
    return frame.groupby("user_id", as_index=False).sum()


def step(old, new):
    n, total = old or (0, 0.0)
    n, total = n + int(new["n"].sum()), total + float(new["total"].sum())
    return None if total >= 5000 else (n, total)


def test_general_state_equals_an_aggregate(spark, log, tmp_path, collected):
    folder, table = log
    tracked = state.update_state(
        read(spark, folder).select("user_id", "value"), "user_id", fold, merge,
        "user_id long, n long, total double", step, STATE,
    )
    got = sinks.run_update(tracked, str(tmp_path / "s"), ["user_id"]).filter("alive").drop("alive")
    expected = table.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    assert collected(got) == collected(expected)


def test_state_is_forgotten_and_starts_again(spark, tmp_path, collected):
    folder = str(tmp_path / "in")
    for i, value in enumerate((10.0, 6000.0, 3.0)):
        write_file(spark, [(START, 1, "a", value), (START, 2, "a", 1.0)], folder, f"f{i}")
    tracked = state.update_state(
        read(spark, folder).select("user_id", "value"), "user_id", fold, merge,
        "user_id long, n long, total double", step, STATE,
    )
    path = str(tmp_path / "s")
    got = sinks.run_update(tracked, path, ["user_id"])
    assert collected(got) == [(1, 1, 3.0, True), (2, 3, 3.0, True)]
    history = sinks.read_batches(spark, path, tracked.schema).filter("user_id = 1").orderBy("batch")
    assert [r.alive for r in history.collect()] == [True, False, True]


@pytest.mark.parametrize("size", [1, 10_000])
def test_step_runs_once_per_key_and_batch_whatever_the_arrow_batches(spark, tmp_path, collected, size):
    folder = str(tmp_path / "in")
    rows = [(START, 1, "a", 1000.0) for _ in range(9)] + [(START, None, "a", 1.0), (START, 2**53 + 1, "a", 1.0), (START, 2**53, "a", 1.0)]
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(f"{folder}/f0")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, size)
    try:
        tracked = state.update_state(
            read(spark, folder, None).select("user_id", "value"), "user_id", fold_all, merge_all,
            "user_id long, n long, total double", lambda old, new: (int(new["n"].iloc[0]), float(new["total"].iloc[0])), STATE,
        )
        got = sinks.run_update(tracked, str(tmp_path / "s"), ["user_id"]).drop("alive")
        distinct = sinks.run_append(state.distinct_rows(read(spark, folder, None).select("user_id")), str(tmp_path / "d"))
        assert collected(got) == [(1, 9, 9000.0), (2**53, 1, 1.0), (2**53 + 1, 1, 1.0), (None, 1, 1.0)]
        assert collected(distinct) == [(1,), (2**53,), (2**53 + 1,), (None,)]
    finally:
        spark.conf.set(setting, before)


def fold_all(frame):
    return frame.groupby("user_id", as_index=False, dropna=False).agg(n=("value", "size"), total=("value", "sum"))


def merge_all(frame):
    return frame.groupby("user_id", as_index=False, dropna=False).sum()


def test_distinct_and_union_of_streams(spark, log, tmp_path, collected):
    folder, table = log
    pairs = state.distinct_rows(read(spark, folder).select("user_id", "word"))
    got = sinks.run_append(pairs, str(tmp_path / "d"))
    assert collected(got) == collected(table.select("user_id", "word").distinct())
    both = read(spark, folder).unionByName(read(spark, folder)).groupBy("word").count()
    twice = sinks.run_complete(both, str(tmp_path / "u"))
    assert twice.agg(F.sum("count")).first()[0] == 400


def test_stream_join_equals_batch_for_any_number_of_parts(spark, log, tmp_path, collected):
    folder, table = log
    def sides(df):
        left = df.filter("word = 'a'").select(F.col("user_id").alias("u"), F.col("ts").alias("t1"))
        right = df.filter("word = 'b'").select("user_id", F.col("ts").alias("t2"), "value")
        return left, right
    left, right = sides(table)
    condition = (F.col("u") == F.col("user_id")) & F.col("t2").between(
        F.col("t1"), F.col("t1") + F.expr("INTERVAL 20 SECONDS")
    )
    expected = collected(left.join(right, condition))
    assert expected
    for salts in (1, 4):
        a, b = sides(read(spark, folder))
        joined = windows.join_within(
            a.withWatermark("t1", "1 minute"), b.withWatermark("t2", "1 minute"),
            "u", "user_id", "t1", "t2", "20 seconds", salts=salts,
        )
        assert collected(sinks.run_append(joined, str(tmp_path / f"j{salts}"))) == expected


def test_state_provider_is_set_only_while_starting(spark, log, tmp_path):
    folder, _ = log
    counts = read(spark, folder).groupBy("word").count()
    sinks.run_complete(counts, str(tmp_path / "a"))
    assert spark.conf.get(sinks.STATE_SETTING, None) is None
    operators = sinks.finish(sinks.per_batch(counts, str(tmp_path / "b"), mode="update")).lastProgress
    assert "rocksdb" in json.dumps(operators["stateOperators"][0]["customMetrics"]).lower()


def test_chained_windows(spark, log, tmp_path):
    folder, table = log
    timed = sources.with_event_time(read(spark, folder, 4), "ts", "1 second")
    got = sinks.run_append(windows.chained_peak(timed, "ts", "10 seconds", "1 minute"), str(tmp_path / "p"))
    per10 = table.groupBy(F.window("ts", "10 seconds")).count()
    peaks = {r["start"]: r["peak"] for r in got.collect()}
    assert peaks
    for start, peak in peaks.items():
        inside = per10.filter(
            (F.col("window.start") >= F.lit(start)) & (F.col("window.end") <= F.lit(start) + F.expr("INTERVAL 1 MINUTE"))
        )
        assert inside.agg(F.max("count")).first()[0] == peak


def test_blacklist_on_a_stream(spark, log, tmp_path, collected):
    folder, table = log
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "user_id long, flag boolean")
    got = sinks.run_append(clicks.valid_clicks(read(spark, folder), flags), str(tmp_path / "v"))
    assert collected(got) == collected(table.filter("user_id <> 1"))


def test_per_batch_counts_are_independent(spark, log, tmp_path):
    folder, _ = log
    path = str(tmp_path / "b")
    sinks.finish(sinks.per_batch(read(spark, folder), path, lambda b, _: b.groupBy("word").count()))
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])
    sizes = sinks.read_batches(spark, path, schema).groupBy("batch").agg(F.sum("count").alias("n"))
    assert sorted(tuple(r) for r in sizes.collect()) == [(i, 50) for i in range(4)]


def test_row_writer_skips_what_is_written(tmp_path):
    writer = sinks.RowFileWriter(str(tmp_path / "w"))
    row = Row(a=1, b="x")
    assert writer.open(0, 7)
    writer.process(row)
    writer.close(None)
    assert not writer.open(0, 7)
    failed = sinks.RowFileWriter(str(tmp_path / "w"))
    assert failed.open(1, 7)
    failed.process(row)
    failed.close(RuntimeError("task lost"))
    assert sinks.RowFileWriter(str(tmp_path / "w")).open(1, 7)  # nothing was published
    lines = (tmp_path / "w" / "batch=7" / "part-00000.json").read_text().splitlines()
    assert [json.loads(x) for x in lines] == [{"a": 1, "b": "x"}]


def test_foreach_memory_and_progress(spark, log, tmp_path, collected):
    folder, table = log
    sinks.finish(sinks.to_foreach(read(spark, folder).select("user_id", "word"), str(tmp_path / "f")))
    back = spark.read.schema("user_id long, word string").json(str(tmp_path / "f" / "batch=*"))
    assert collected(back) == collected(table.select("user_id", "word"))
    counts = read(spark, folder).groupBy("word").count()
    with sinks.ProgressLog(spark) as log:
        query = sinks.finish(sinks.to_memory(counts, "word_counts", str(tmp_path / "m")))
        progress = log.frame(query)
    assert collected(spark.table("word_counts")) == collected(table.groupBy("word").count())
    assert progress.agg(F.sum("input_rows")).first()[0] == 200
    assert query.exception() is None and not query.isActive


def test_append_mode_refuses_an_open_aggregate(spark, log, tmp_path):
    folder, _ = log
    with pytest.raises(Exception, match="(?i)append"):
        sinks.run_append(read(spark, folder).groupBy("word").count(), str(tmp_path / "x"))


def descend(weights, x, y, step):
    return weights - step * ((x @ weights - y)[:, None] * x).mean(axis=0)


@pytest.mark.parametrize("written_out", [64, 1])
def test_online_models_follow_gradient_descent(spark, tmp_path, monkeypatch, written_out):
    monkeypatch.setattr(online, "WRITTEN_OUT", written_out)
    rng = np.random.default_rng(0)
    folder = str(tmp_path / "points")
    batches = []
    for i in range(3):
        x = rng.normal(size=(40, 2))
        y = x @ np.array([2.0, -1.0])
        batches.append((x, y))
        points = [(float(b), [float(v) for v in a]) for a, b in zip(x, y)]
        spark.createDataFrame(points, "label double, features array<double>").coalesce(1).write.parquet(f"{folder}/f{i}")
        time.sleep(0.02)
    stream = sources.stream_files(spark, f"{folder}/f*", "label double, features array<double>", max_files=1)
    models = OnlineLinearModels(str(tmp_path / "m"), {"slow": 0.01, "fast": 0.5}, width=2)
    sinks.finish(models.train_on(stream))
    for name, size in models.steps.items():
        weights, errors = np.zeros(2), []
        for x, y in batches:
            errors.append(((x @ weights - y) ** 2).mean())
            weights = descend(weights, x, y, size)
        np.testing.assert_allclose(models.weights(spark, 3)[name], weights)
        stored = models.results(spark, "errors").filter(F.col("model") == name).orderBy("batch")
        np.testing.assert_allclose([r.mse for r in stored.collect()], errors)
    final = models.results(spark, "errors").filter("batch = 2").collect()
    by_model = {r.model: r.mse for r in final}
    assert by_model["fast"] < by_model["slow"]
    assert models.results(spark, "predictions").count() == 120


@pytest.mark.parametrize("written_out", [64, 1])
def test_rows_without_label_or_features_are_not_learned_from(spark, tmp_path, monkeypatch, written_out):
    monkeypatch.setattr(online, "WRITTEN_OUT", written_out)
    schema = "label double, features array<double>"
    rows = [(2.0, [1.0, 0.0]), (None, [5.0, 5.0]), (4.0, None), (1.0, [None, 1.0]), (4.0, [0.0, 1.0])]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/f0")
    models = OnlineLinearModels(str(tmp_path / "m"), {"m": 1.0}, width=2)
    sinks.finish(models.train_on(sources.stream_files(spark, f"{tmp_path}/in/f*", schema)))
    assert models.weights(spark, 1)["m"] == [1.0, 2.0]
    assert models.results(spark, "errors").first()["mse"] == 10.0
    assert models.results(spark, "predictions").count() == 5


def test_kafka_and_socket_plumbing(spark):
    options = sources.kafka_options(["a:9092", "b:9092"], ["t1", "t2"], "earliest", 500)
    assert options == {
        "kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "t1,t2",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500",
    }


def test_jdbc_sink_replaces_per_batch(spark, log, tmp_path, monkeypatch):
    folder, _ = log
    written = []
    monkeypatch.setattr(sinks, "sink_jdbc", lambda df, db, table, mode: written.append((table, mode, df.count())))
    database = Database("jdbc:none:", {"user": "u"})
    counts = read(spark, folder, 2).groupBy("word").count()
    sinks.finish(sinks.to_jdbc(counts, database, "counts", str(tmp_path / "a")))
    assert written == [("counts", "overwrite", 4)] * 2
    written.clear()
    sinks.finish(sinks.to_jdbc(counts, database, "counts", str(tmp_path / "b"), mode="update"))
    assert [w[:2] for w in written] == [("counts_0", "overwrite"), ("counts_1", "overwrite")]


def test_complete_mode_keeps_the_newest_result_only(spark, log, tmp_path):
    folder, _ = log
    sinks.run_complete(read(spark, folder).groupBy("word").count(), str(tmp_path / "c"))
    assert [p.name for p in (tmp_path / "c").glob("batch=*")] == ["batch=3"]


AGES = T.StructType([T.StructField("n", T.LongType()), T.StructField("idle", T.LongType())])


def aged(stream, path, versions=None):
    return state.update_every_key(
        stream,
        path,
        ["user_id", "word"],
        {"n": F.count("*"), "last": F.max("value")},
        {
            "n": F.coalesce(F.col("old.n"), F.lit(0)) + F.coalesce(F.col("new.n"), F.lit(0)),
            "idle": F.when(F.col("new").isNull(), F.col("old.idle") + 1).otherwise(0),
        },
        AGES,
        keep=F.col("idle") < 2,
        versions=versions,
    )


def plain_ages(batches):
    held, out = {}, []
    for number, rows in enumerate(batches):
        fresh = {}
        for _, user, word, _ in rows:
            fresh[(user, word)] = fresh.get((user, word), 0) + 1
        for key in set(held) | set(fresh):
            n, idle = held.get(key, (0, -1))
            held[key] = (n + fresh.get(key, 0), 0 if key in fresh else idle + 1)
        held = {k: v for k, v in held.items() if v[1] < 2}
        out += [(*key, *value, number) for key, value in held.items()]
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_every_known_key_is_stepped_in_every_batch(spark, tmp_path, collected):
    at = START
    batches = [
        [(at, 1, "a", 1.0), (at, 2, "a", 1.0), (at, None, "a", 1.0), (at, 3, None, 2.0), (at, 1, "a", 5.0)],
        [(at, 1, "a", 1.0), (at, None, "a", 4.0)],
        [(at, 1, "b", 1.0)],
        [(at, 2, "a", 1.0), (at, 3, None, None)],
        [(at, 9, "z", 1.0)],
    ]
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    for number, rows in enumerate(batches):
        write_file(spark, rows, folder, f"f{number}")
        sinks.finish(aged(read(spark, folder), path))
    key = T.StructType.fromDDL("user_id long, word string")
    got = sinks.read_batches(spark, path, T.StructType([*key.fields, *AGES.fields]))
    assert collected(got) == ordered(plain_ages(batches))


def test_old_states_are_removed_and_a_repeated_batch_gives_the_same(spark, tmp_path, collected):
    batches = [[(START, u, "a", 1.0) for u in range(4) if (u + k) % 3] for k in range(5)]
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    for number, rows in enumerate(batches):
        write_file(spark, rows, folder, f"f{number}")
    sinks.finish(aged(read(spark, folder), path, versions=2))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["batch=3", "batch=4"]
    key = T.StructType.fromDDL("user_id long, word string")
    def states():
        return collected(sinks.read_batches(spark, path, T.StructType([*key.fields, *AGES.fields])))
    want = ordered(r for r in plain_ages(batches) if r[-1] >= 3)
    assert states() == want
    # The last batch was not noted as done: it runs again after a restart.
    (tmp_path / "out-checkpoint" / "commits" / "4").unlink()
    (tmp_path / "out-checkpoint" / "commits" / ".4.crc").unlink(missing_ok=True)
    sinks.finish(aged(read(spark, folder), path, versions=2))
    assert states() == want


def test_state_needs_its_predecessor_and_all_steps(spark, log, tmp_path):
    with pytest.raises(ValueError):
        aged(read(spark, log[0]), str(tmp_path), versions=1)
    with pytest.raises(ValueError):
        state.update_every_key(read(spark, log[0]), str(tmp_path), ["word"], {"n": F.count("*")}, {"n": F.lit(1)}, AGES)


@pytest.mark.parametrize("length, slide", [("60 seconds", "10 seconds"), ("10 minutes", "5 minutes"), ("30 seconds", "30 seconds")])
def test_panes_equal_windows_of_rows(spark, log, tmp_path, collected, length, slide):
    folder, table = log
    want = collected(windows.window_aggregate(table, "ts", length, slide, "word", n=F.count("*"), top=F.max("value")))
    pairs = {"n": (F.count("*"), F.sum("n")), "top": (F.max("value"), F.max("top"))}
    assert collected(windows.pane_aggregate(table, "ts", length, slide, "word", **pairs)) == want
    stream = sources.with_event_time(read(spark, folder), "ts", "20 seconds")
    closed = sinks.run_append(windows.pane_aggregate(stream, "ts", length, slide, "word", **pairs), str(tmp_path / "out"))
    mark = table.agg(F.max("ts")).first()[0] - timedelta(seconds=20)
    assert collected(closed) == [r for r in want if r[1] <= mark]


def test_panes_fold_rows_before_windows(spark, log):
    table = log[1]
    plan = windows.sliding_count(table, "ts", "word")._jdf.queryExecution().optimizedPlan().toString()
    # The rows meet one aggregate per pane below the node that copies panes into windows.
    assert plan.index("Aggregate") < plan.index("Expand") < plan.rindex("Aggregate")
    with pytest.raises(ValueError):
        windows.sliding_count(table, "ts", "word", length="60 seconds", slide="25 seconds")


@pytest.mark.parametrize("salts", [1, 5])
def test_left_join_emits_rows_without_partner_once(spark, tmp_path, collected, salts):
    rng = np.random.default_rng(8)
    def side(n, name):
        rows = sorted((START + timedelta(seconds=int(rng.integers(0, 900))), int(rng.choice([1, 1, 2, 3, 4])), i) for i in range(n))
        return spark.createDataFrame(rows, f"{name}_ts timestamp, {name}_key long, {name}_id long"), rows
    (left, left_rows), (right, right_rows) = side(60, "l"), side(25, "r")
    streams = []
    for name, df in (("l", left), ("r", right)):
        df.coalesce(1).write.parquet(str(tmp_path / name / "f"))
        stream = sources.stream_files(spark, str(tmp_path / name / "f*"), df.schema)
        streams.append(sources.with_event_time(stream, f"{name}_ts", "10 seconds"))
    joined = windows.join_within(*streams, "l_key", "r_key", "l_ts", "r_ts", "60 seconds", salts=salts, how="left")
    got = collected(sinks.run_append(joined.select("l_id", "r_id"), str(tmp_path / "out")))
    span = timedelta(seconds=60)
    mark = min(max(r[0] for r in left_rows), max(r[0] for r in right_rows)) - timedelta(seconds=10)
    want = [(i, j) for a, k, i in left_rows for b, m, j in right_rows if k == m and a <= b <= a + span]
    alone = [(i, None) for a, k, i in left_rows if i not in {x for x, _ in want} and a + span < mark]
    assert len(alone) > 5 and got == ordered(want + alone)
    with pytest.raises(ValueError):
        windows.join_within(*streams, "l_key", "r_key", "l_ts", "r_ts", "60 seconds", how="right")


def test_inner_join_keeps_few_copies_and_finds_partners_over_restarts(spark, tmp_path, collected):
    """Rows of one key, at the ends of the span and of its slots, in two batches."""
    span = timedelta(seconds=60)
    lefts = [(START + timedelta(seconds=30 * k), k) for k in range(40)]
    rights = [(START + timedelta(seconds=s), k) for k, s in enumerate([0, 1, 59, 60, 61, 119, 120, 121, 180, 599, 600, 1169, 1230, 1231])]
    want = ordered([(i, j) for a, i in lefts for b, j in rights if a <= b <= a + span])
    for half in (0, 1):
        parts = {"l": lefts[20 * half : 20 * half + 20], "r": rights[7 * half : 7 * half + 7]}
        streams = []
        for name, rows in parts.items():
            frame = spark.createDataFrame([(t, 1, i) for t, i in rows], f"{name}_ts timestamp, {name}_key long, {name}_id long")
            frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
            streams.append(sources.with_event_time(sources.stream_files(spark, str(tmp_path / name), frame.schema), f"{name}_ts", "1 hour"))
        joined = windows.join_within(*streams, "l_key", "r_key", "l_ts", "r_ts", "60 seconds")
        query = sinks.finish(sinks.to_files(joined.select("l_id", "r_id"), str(tmp_path / "out"), idle=False))
        # One batch a run, and each left row is copied to two slots only.
        progress = query.recentProgress
        assert len([p for p in progress if p["numInputRows"]]) == len(progress) == 1
        assert progress[0]["stateOperators"][0]["numRowsUpdated"] <= 2 * len(parts["l"]) + len(parts["r"])
        assert spark.conf.get(sinks.IDLE_SETTING, None) is None
    assert collected(spark.read.parquet(str(tmp_path / "out"))) == want


def test_state_on_disk_counts_no_rows(spark, log, tmp_path):
    """The store looks up no key just for a total; what the session names stays."""
    folder, _ = log
    counts = read(spark, folder).groupBy("word").count()
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    assert sinks.finish(sinks.per_batch(counts, str(tmp_path / "a"), mode="update")).lastProgress["stateOperators"][0]["numRowsTotal"] == 0
    spark.conf.set(name, "true")
    try:
        assert sinks.finish(sinks.per_batch(counts, str(tmp_path / "b"), mode="update")).lastProgress["stateOperators"][0]["numRowsTotal"] > 0
        assert spark.conf.get(name) == "true"
    finally:
        spark.conf.unset(name)
