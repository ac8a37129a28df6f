"""Streams: counts, restart, milestones over several batches, late rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from vitrine.streaming import lateness, progress, runs
from vitrine.workspace import root, scratch

SCHEMA = "container string, ts timestamp, ok boolean, duration double"
START = datetime.datetime(2024, 1, 1)


def rows(container, n, minute=0):
    return [(container, START + datetime.timedelta(minutes=minute, seconds=i / 10), i % 5 != 0, float(i)) for i in range(n)]


def arrive(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_workspace_uses_the_folder_of_the_session(spark):
    assert root(spark) == spark.conf.get("spark.checkpoint.dir", root(spark)).rstrip("/")


def test_counts_go_on_after_a_restart(spark):
    source, out, checkpoint = (scratch(spark, x) for x in ("in", "out", "cp"))
    for data in (rows("a", 30) + rows("b", 5), rows("a", 10), rows("c", 7)):
        arrive(spark, source, data)
        stream = progress.read_stream(spark, source, SCHEMA, files_per_batch=1)
        progress.run_to_end(progress.progress_counts(stream, "container", F.col("ok")), checkpoint, progress._save(out), "update")
    got = {r["container"]: (r["processed"], r["success"], r["failed"]) for r in progress.latest(spark, out, ["container"]).collect()}
    assert got == {"a": (40, 32, 8), "b": (5, 4, 1), "c": (7, 5, 2)}


def test_milestones_over_batches_are_reported_once(spark):
    source, checkpoint = scratch(spark, "in"), scratch(spark, "cp")
    log = progress.MilestoneLog(spark, scratch(spark, "ms"), "container", F.col("ok"))
    for data in (rows("a", 150) + rows("b", 99), rows("a", 400) + rows("b", 1), rows("b", 50)):
        arrive(spark, source, data)
        progress.run_to_end(progress.read_stream(spark, source, SCHEMA, files_per_batch=1), checkpoint, log, "append")
    got = sorted((r["container"], r["reached"], r["stage"]) for r in log.rows().collect())
    assert got == sorted(
        [("a", 0, "started"), ("b", 0, "started"), ("b", 100, "progress"), ("a", 500, "milestone")]
        + [("a", n, "progress") for n in (100, 200, 300, 400)])


def test_repeating_a_batch_changes_nothing(spark):
    log = progress.MilestoneLog(spark, scratch(spark, "ms"), "container", F.col("ok"))
    first, second = (spark.createDataFrame(rows("a", n), SCHEMA) for n in (120, 130))
    log(first, 0)
    log(second, 1)
    before = sorted(map(tuple, log.rows().collect()))
    log(second, 1)
    assert sorted(map(tuple, log.rows().collect())) == before
    assert [r["reached"] for r in log.rows().orderBy("reached").collect()] == [0, 100, 200]


def test_late_rows_count_unless_a_lateness_is_set(spark):
    def urls(lateness):
        source, out, checkpoint = (scratch(spark, x) for x in ("in", "out", "cp"))
        for data in (rows("a", 10), rows("a", 10, minute=60), rows("a", 10), rows("a", 1, minute=61)):
            arrive(spark, source, data)
            stream = progress.read_stream(spark, source, SCHEMA, files_per_batch=1)
            progress.run_to_end(progress.throughput(stream, "ts", F.col("ok"), "duration", "1 minute", lateness),
                                checkpoint, progress._save(out), "update")
        return {r["window_start"].minute + 60 * r["window_start"].hour: r["urls"]
                for r in progress.latest(spark, out, ["window_start"]).collect()}

    assert urls(None) == {0: 20, 60: 10, 61: 1}
    assert urls("10 minutes") == {0: 10, 60: 10, 61: 1}


def test_percentiles_of_many_values_are_exact(spark):
    """A window with 60,000 different times, over several batches: a sketch of 10,000 is off by some ranks."""
    n, source = 60_000, scratch(spark, "in")
    data = spark.range(n).selectExpr(
        "timestamp'2026-01-01 00:00:00' AS ts", "id % 3 > 0 AS ok", "CAST((id * 7919) % 60000 AS DOUBLE) AS duration", "id % 4 AS part"
    ).unionByName(spark.sql("SELECT timestamp'2026-01-01 02:00:00' AS ts, true AS ok, CAST(NULL AS DOUBLE) AS duration, 0L AS part"))
    for part in range(4):
        data.where(f"part = {part}").drop("part").coalesce(1).write.mode("append").parquet(source)
    stream = progress.read_stream(spark, source, data.drop("part").schema, files_per_batch=1)
    got = progress.follow_throughput(spark, stream, "ts", F.col("ok"), "duration", "1 hour").orderBy("window_start").collect()
    assert [(r["urls"], r["p50"], r["p95"]) for r in got] == [(n, n / 2 - 1, n * 0.95 - 1), (1, None, None)]
    assert got[0]["success_rate"] == pytest.approx(2 / 3) and got[0]["failure_rate"] == pytest.approx(1 / 3)


# ---- runs: started, progress, milestones, errors, completed ----

RUN = "container string, ts timestamp, id long, ok boolean, planned long"


def items(container, n, hour=0.0, first=0, ok=lambda i: True, planned=None, every=1.0):
    return [(container, START + datetime.timedelta(hours=hour, seconds=i * every), first + i, ok(i), planned) for i in range(n)]


def plain_runs(data, silence, lateness, critical=runs.CRITICAL):
    """Events of all containers by going through their items one by one."""
    out, mark = [], max(ts for _, ts, *_ in data) - lateness
    for c in {d[0] for d in data}:
        run, counts, streak, last = 0, [0, 0], 0, None
        for _, ts, _, ok, planned in sorted((d for d in data if d[0] == c), key=lambda d: d[1:3]):
            if sum(counts) and ts - last > silence:
                out.append((c, run, "completed", *counts, "silent"))
                counts, streak = [0, 0], 0
            if not sum(counts):
                run += 1
                out.append((c, run, "started", 0, 0, None))
            counts[0 if ok else 1] += 1
            streak, last, n = 0 if ok else streak + 1, ts, sum(counts)
            if n in (500, 1000, 2500, 5000) or n % 100 == 0:
                out.append((c, run, "milestone" if n in (500, 1000, 2500, 5000) else "progress", *counts, None))
            if streak == critical:
                out.append((c, run, "errors", *counts, f"{critical} failures in a row"))
            if planned and n >= planned:
                out.append((c, run, "completed", *counts, "planned"))
                counts, streak = [0, 0], 0
        if sum(counts) and last + silence <= mark:
            out.append((c, run, "completed", *counts, "silent"))
    return sorted(out, key=str)


def follow_in_batches(spark, batches, restart_after=None):
    source, path, checkpoint = (scratch(spark, x) for x in ("in", "events", "cp"))
    found = None
    for i, data in enumerate(batches):
        spark.createDataFrame(data, RUN).coalesce(1).write.mode("append").parquet(source)
        if i == restart_after or i == len(batches) - 1:
            stream = progress.read_stream(spark, source, RUN, files_per_batch=1)
            events = runs.run_events(stream, "container", "ts", "id", F.col("ok"), "2 hours", "10 minutes", F.col("planned"))
            found = runs.follow_runs(spark, events, path, checkpoint)
    return sorted(((r["container"], r["run"], r["stage"], r["success"], r["failed"], r["reason"]) for r in found.collect()), key=str)


BATCHES = [
    items("a", 650, planned=900) + items("b", 120, ok=lambda i: i % 10 > 3) + items("c", 5),
    items("a", 249, hour=0.5, first=650, planned=900, ok=lambda i: False) + items("b", 30, hour=1, first=120),
    items("b", 40, hour=6, first=150, ok=lambda i: i > 1) + items("b", 60, hour=9, first=200) + items("a", 1, hour=6, first=899, planned=900),
    items("d", 3, hour=10, planned=2) + items("z", 1, hour=40),
]


@pytest.mark.parametrize("restart_after", [None, 0, 2])
def test_events_of_runs_come_once(spark, restart_after):
    want = plain_runs([d for b in BATCHES for d in b], datetime.timedelta(hours=2), datetime.timedelta(minutes=10))
    assert {stage for _, _, stage, *_ in want} == {"started", "progress", "milestone", "errors", "completed"}
    assert follow_in_batches(spark, BATCHES, restart_after) == want


def test_the_state_store_of_the_session_stays(spark):
    before = spark.conf.get(runs.PROVIDER, None)
    follow_in_batches(spark, [items("a", 3)])
    assert spark.conf.get(runs.PROVIDER, None) == before


# ---- windows that close ----


def test_closed_windows_and_late_rows(spark):
    source, path = scratch(spark, "in"), scratch(spark, "windows")
    batches = [rows("a", 10), rows("a", 20, minute=60), rows("a", 7, minute=3) + rows("a", 5, minute=55), rows("a", 2, minute=200)]
    closed, late = None, None
    for data in batches:  # the streams stop after every batch
        arrive(spark, source, data)
        stream = progress.read_stream(spark, source, SCHEMA, files_per_batch=1)
        closed, late = lateness.follow_closed_windows(spark, stream, "ts", F.col("ok"), "duration", "1 minute", "10 minutes", path)
    minute = lambda t: t.minute + 60 * t.hour
    assert {minute(r["window_start"]): r["urls"] for r in closed.collect()} == {0: 10, 60: 20, 55: 5}
    gone = late.late(stream.schema).collect()
    assert len(gone) == 7 and {(minute(r["ts"]), r["batch"]) for r in gone} == {(3, 2)}
    assert [(r["rows"], r["late_rows"]) for r in late.ledger().orderBy("batch").collect()] == [(10, 0), (20, 0), (12, 7), (2, 0)]


def test_a_repeated_batch_is_parted_as_before(spark):
    late = lateness.LateRows(spark, scratch(spark, "split"), "ts", "1 minute", "10 minutes")
    first, second = (spark.createDataFrame(d, SCHEMA) for d in (rows("a", 10, minute=60), rows("a", 5)))
    late(first, 0)
    late(second, 1)
    late(second, 1)
    assert late.late(first.schema).count() == 5 and late.ledger().count() == 2
    assert [f.count("late=") for f in spark.read.parquet(f"{late.path}/rows").inputFiles()].count(1) == len(spark.read.parquet(f"{late.path}/rows").inputFiles())
