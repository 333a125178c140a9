"""Sliding windows from one state of panes: equal to chained windows, whatever the batches."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.reports import clicks
from millrace.streaming import panes, sinks, sources, windows

SCHEMA = "ts timestamp, category string, product long, value double"
START = datetime(2024, 1, 1)


def aggregates():
    return {"n": (F.count("*"), F.sum("n")), "top": (F.max("value"), F.max("top"))}


def make_files(spark, folder, jitter, files=5, rows=60, seed=3):
    """Files in order of time, with gaps, nulls and rows up to ``jitter`` seconds late."""
    rng = np.random.default_rng(seed)
    for number in range(files):
        made = []
        for _ in range(rows):
            second = number * 200 + int(rng.integers(0, 120)) - int(rng.integers(0, jitter + 1))
            category = ["a", "b", None][int(rng.integers(0, 3))]
            made.append((START + timedelta(seconds=second), category, int(rng.integers(0, 4)), float(rng.integers(0, 100))))
        made.append((None, "a", 1, 1.0))
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(f"{folder}/f{number}")


def read(spark, folder, delay="20 seconds"):
    return sources.with_event_time(sources.stream_files(spark, f"{folder}/f*", SCHEMA, max_files=1), "ts", delay)


@pytest.mark.parametrize(
    "length, slide, keys, jitter",
    [("60 seconds", "10 seconds", ["category", "product"], 90), ("10 minutes", "5 minutes", [], 90), ("30 seconds", "30 seconds", ["product"], 0)],
)
def test_windows_equal_those_of_two_states(spark, tmp_path, collected, length, slide, keys, jitter):
    folder = str(tmp_path / "in")
    make_files(spark, folder, jitter)
    chained = windows.pane_aggregate(read(spark, folder), "ts", length, slide, *keys, **aggregates())
    want = collected(sinks.run_append(chained, str(tmp_path / "chained")))
    got = panes.run_windows(read(spark, folder), str(tmp_path / "out"), "ts", length, slide, keys, aggregates())
    assert got.schema.names == chained.schema.names
    assert collected(got) == want and len(want) > 1


def test_windows_after_a_gap_close_without_a_pane_of_their_own(spark, tmp_path, collected):
    """The watermark stops between the last pane of a window and its end, then nothing comes for long."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    ends = []
    for number, second in enumerate([5, 55, 3000]):
        row = (START + timedelta(seconds=second), "a", 1, 1.0)
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.parquet(f"{folder}/f{number}")
        got = panes.run_windows(read(spark, folder), path, "ts", "60 seconds", "10 seconds", ["product"], aggregates())
        ends.append(sorted((int((r.end - START).total_seconds()), r.n) for r in got.select("end", "n").collect()))
    first = [(10, 1), (20, 1), (30, 1)]
    assert ends == [[], first, first + [(40, 1), (50, 1), (60, 2)] + [(e, 1) for e in range(70, 120, 10)]]


def test_repeated_batch_gives_the_same_and_old_panes_go(spark, tmp_path, collected):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    make_files(spark, folder, 30)

    def run():
        got = panes.run_windows(read(spark, folder), path, "ts", "60 seconds", "10 seconds", ["product"], aggregates())
        return collected(got)

    want = run()
    last = max(int(p.name) for p in (tmp_path / "out-checkpoint" / "commits").iterdir() if p.name.isdigit())
    kept = sorted(p.name for p in (tmp_path / "out-open").iterdir())
    assert kept == [f"batch={last - 1}", f"batch={last}"]
    assert not [p for p in (tmp_path / "out-panes").iterdir() if p.name.startswith("batch=")]
    (tmp_path / "out-checkpoint" / "commits" / str(last)).unlink()
    (tmp_path / "out-checkpoint" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    assert run() == want


def test_length_must_be_whole_slides(spark, tmp_path):
    make_files(spark, str(tmp_path / "in"), 0, files=1)
    with pytest.raises(ValueError):
        panes.run_windows(read(spark, str(tmp_path / "in")), str(tmp_path / "o"), "ts", "60 seconds", "25 seconds", [], aggregates())


def test_windows_are_not_shuffled(spark):
    schema = "`end` timestamp, _pane boolean, category string, product long, n long"
    rows = [(START + timedelta(seconds=10 * s), True, "a", s % 7, 1) for s in range(300)]
    counts = panes.windows_between(
        spark.createDataFrame(rows, schema), 60 * 10**6, 10**7, ["category", "product"],
        panes.count_rows(), None, int(START.timestamp() * 1e6) + 10**10, ["category"],
    )
    plan = clicks.hot_products(counts)._jdf.queryExecution().executedPlan().toString()
    # Panes once, below the copies; beside them only the rows that each task ranks among its first three.
    assert plan.count("Exchange") == 2
    copies = plan.rindex("_end#", 0, plan.rindex("Generate"))
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") and copies < plan.rindex("Exchange")


@pytest.mark.parametrize(
    "name", ["t09_stream_sliding_count", "t10_stream_event_window", "t29_stream_window_total", "r10_hot_words_sliding", "r11_top3_hot_product"]
)
def test_queries_keep_panes_in_one_state(spark, monkeypatch, name):
    seen, finish = [], sinks.finish
    monkeypatch.setattr(sinks, "finish", lambda query: seen.append(finish(query)) or seen[-1])
    result = contract.QUERIES[name](spark, "/root/testdata/sf0.001")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    written = 0
    for progress in seen[0].recentProgress:
        assert len(progress.stateOperators) == 1
        written += progress.stateOperators[0].numRowsUpdated
    # A pane and its marks: no window of a product is ever put into the state.
    assert result.count() and written <= events * 6
