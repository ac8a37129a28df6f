"""Streaming queries over the events table read as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.plans import inputs as I
from vitrine.plans.registry import query
from vitrine.sources.tables import read_parquet
from vitrine.streaming import lateness, progress, runs
from vitrine.workspace import scratch, stage

def _events(spark, sf):
    schema = read_parquet(spark, sf, "events").schema
    raw = progress.read_stream(spark, sf, schema, "events.parquet")
    return raw.selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", "concat('unit', CAST(user_id % 8 AS STRING)) AS container",
                          "event_type <> 'error' AS ok", "value AS duration")


@query("stream_progress_counts", f"SELECT container, count(*) AS processed, count(*) FILTER (WHERE ok) AS success, count(*) FILTER (WHERE NOT ok) AS failed FROM ({I.RUN_SQL}) GROUP BY 1")
def stream_progress_counts(spark, sf):
    return progress.follow(spark, progress.progress_counts(_events(spark, sf), "container", F.col("ok")), ["container"])


@query("stream_throughput", f"""SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS urls,
 round(count(*) FILTER (WHERE ok) * 1.0 / count(*), 6) AS success_rate, round(count(*) FILTER (WHERE NOT ok) * 1.0 / count(*), 6) AS failure_rate,
 quantile_disc(duration, 0.5) AS p50, quantile_disc(duration, 0.95) AS p95 FROM ({I.RUN_SQL}) GROUP BY 1""")
def stream_throughput(spark, sf):
    rows = progress.follow_throughput(spark, _events(spark, sf), "ts", F.col("ok"), "duration", "1 hour")
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "urls",
                       F.round("success_rate", 6).alias("success_rate"), F.round("failure_rate", 6).alias("failure_rate"), "p50", "p95")


@query("stream_progress_marks", f"""WITH t AS (SELECT container, count(*) AS processed FROM ({I.RUN_SQL}) GROUP BY 1),
 r AS (SELECT container, unnest(range(0, processed + 1, 100)) AS reached FROM t)
 SELECT container, reached, CASE WHEN reached = 0 THEN 'started' WHEN reached IN (500, 1000, 2500, 5000) THEN 'milestone' ELSE 'progress' END AS stage FROM r""")
def stream_progress_marks(spark, sf):
    return progress.follow_milestones(spark, _events(spark, sf), "container", F.col("ok")).rows()


SILENCE, LATENESS = "12 hours", "1 hour"
# A container works for ten days; for those of even units the number of items is planned.
STAGE_RUNS = f"""SELECT event_id, ts, ok, concat(container, '/', CAST(floor((day(ts) - 1) / 10) AS INT)) AS container,
 user_id % 2 = 0 AS has_plan FROM ({I.RUN_SQL})"""


@query("stream_milestones", f"""WITH e AS ({STAGE_RUNS}),
 g AS (SELECT *, CASE WHEN has_plan THEN count(*) OVER (PARTITION BY container) END AS planned,
  coalesce(ts - lag(ts) OVER (PARTITION BY container ORDER BY ts, event_id) > INTERVAL {SILENCE}, true) AS starts FROM e),
 r AS (SELECT *, sum(starts::INT) OVER (PARTITION BY container ORDER BY ts, event_id)::BIGINT AS run FROM g),
 c AS (SELECT *, row_number() OVER w AS n, sum(ok::INT) OVER w AS good FROM r WINDOW w AS (PARTITION BY container, run ORDER BY ts, event_id)),
 s AS (SELECT *, n - coalesce(max(CASE WHEN ok THEN n END) OVER (PARTITION BY container, run ORDER BY n), 0) AS streak FROM c),
 t AS (SELECT container, run, max(n) AS n, max(good) AS good, max(ts) AS last, max(planned) AS planned,
  run = max(run) OVER (PARTITION BY container) AS newest FROM s GROUP BY container, run),
 a AS (SELECT container, run, 'started' AS stage, 0 AS reached, 0 AS success, NULL AS reason FROM t
  UNION ALL SELECT container, run, CASE WHEN n IN (500, 1000, 2500, 5000) THEN 'milestone' ELSE 'progress' END, n, good, NULL FROM s WHERE n % 100 = 0
  UNION ALL SELECT container, run, 'errors', n, good, '3 failures in a row' FROM s WHERE NOT ok AND streak = 3
  UNION ALL SELECT container, run, 'completed', n, good, CASE WHEN n = planned THEN 'planned' ELSE 'silent' END FROM t
   WHERE n = planned OR NOT newest OR last + INTERVAL {SILENCE} <= (SELECT max(ts) FROM e) - INTERVAL {LATENESS})
 SELECT container, run, stage, reached::BIGINT AS reached, success::BIGINT AS success, (reached - success)::BIGINT AS failed, reason FROM a""")
def stream_milestones(spark, sf):
    container = F.concat_ws("/", "container", F.floor((F.day("ts") - 1) / 10).cast("string"))
    items = _events(spark, sf).withColumn("container", container)
    plan = I.runs(spark, sf).where("user_id % 2 = 0").groupBy(container.alias("container")).agg(F.count(F.lit(1)).alias("planned"))
    items = items.join(stage(plan, "plan"), "container", "left")
    events = runs.run_events(items, "container", "ts", "event_id", F.col("ok"), SILENCE, LATENESS, F.col("planned"))
    return runs.follow_runs(spark, events).drop("at")


# Rows arrive in blocks of five days; one in 37 a block late.
ARRIVAL = "CAST(floor((day(ts) - 1) / 5) AS INT) + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END"
SQL_ARRIVED = f"""e AS (SELECT event_id, ts, ok, duration, {ARRIVAL} AS batch FROM ({I.RUN_SQL})),
 b AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS mark FROM e GROUP BY batch),
 m AS (SELECT e.*, time_bucket(INTERVAL '1 hour', ts) AS start, coalesce(time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR <= mark, false) AS late FROM e JOIN b USING (batch))"""


def _closed_windows(spark, sf):
    """The stream of arriving rows, one file a batch, and what its windows come to."""
    folder = scratch(spark, "arriving")
    rows = I.runs(spark, sf).select("event_id", "ts", "ok", "duration", F.expr(ARRIVAL).alias("batch"))
    rows = stage(rows, "arrivals")
    blocks = rows.agg(F.min("batch"), F.max("batch")).first()
    for i in range(blocks[0], blocks[1] + 1):
        rows.where(F.col("batch") == i).drop("batch").coalesce(1).write.mode("append").parquet(folder)
    stream = progress.read_stream(spark, folder, rows.drop("batch").schema, files_per_batch=1)
    return lateness.follow_closed_windows(spark, stream, "ts", F.col("ok"), "duration", "1 hour", "1 day")


@query("stream_closed_windows", f"""WITH {SQL_ARRIVED} SELECT strftime(start, '%Y-%m-%d %H:%M') AS window_start, count(*) AS urls,
 round(count(*) FILTER (WHERE ok) * 1.0 / count(*), 6) AS success_rate, round(count(*) FILTER (WHERE NOT ok) * 1.0 / count(*), 6) AS failure_rate,
 quantile_disc(duration, 0.5) AS p50, quantile_disc(duration, 0.95) AS p95 FROM m
 WHERE NOT late AND start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM e) - INTERVAL 1 DAY GROUP BY 1""")
def stream_closed_windows(spark, sf):
    closed, _ = _closed_windows(spark, sf)
    return closed.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "urls",
                         F.round("success_rate", 6).alias("success_rate"), F.round("failure_rate", 6).alias("failure_rate"), "p50", "p95")


@query("stream_late_rows", f"WITH {SQL_ARRIVED} SELECT event_id, batch::BIGINT AS batch, count(*) OVER (PARTITION BY batch) AS late_rows FROM m WHERE late")
def stream_late_rows(spark, sf):
    """The late rows, each with the number of late rows of its batch as the ledger has it."""
    _, late = _closed_windows(spark, sf)
    schema = I.runs(spark, sf).select("event_id", "ts", "ok", "duration").schema
    return late.late(schema).select("event_id", "batch").join(late.ledger().select(F.col("batch").cast("long").alias("batch"), "late_rows"), "batch")


@query("stream_resume", "SELECT event_id, event_type FROM events")
def stream_resume(spark, sf):
    """Half of the rows arrive, the stream stops, the rest arrives, and it goes on from its checkpoint."""
    source, target, checkpoint = (scratch(spark, x) for x in ("arriving", "resumed", "stream-checkpoint"))
    events = read_parquet(spark, sf, "events").select("event_id", "event_type")
    for first in (True, False):
        part = events.where((F.col("event_id") % 2 == 0) == F.lit(first))
        part.write.mode("append").parquet(source)
        progress.append_stream(progress.read_stream(spark, source, events.schema, files_per_batch=2), target, checkpoint)
    return spark.read.schema(events.schema).parquet(target)


@query("stream_append_results", f"SELECT event_id, container, ok FROM ({I.RUN_SQL})")
def stream_append_results(spark, sf):
    target = scratch(spark, "results")
    results = _events(spark, sf).select("event_id", "container", "ok")
    progress.append_stream(results, target, scratch(spark, "stream-checkpoint"))
    return spark.read.schema(results.schema).parquet(target)
