"""Events of container runs: started, progress, milestones, errors and completion, from keyed state with timers.

The state of a container is one row of counts. A run begins with the container's first item and ends when it has its planned number of items or has been
silent, in event time, for `silence`; the next item then begins a new run. Silence inside a batch shows between two items, silence
at the end is told by a timer that fires when the watermark passes it. Counts are taken in order of time and a unique id, so the events are
the same for any cut into batches, as long as no item is later than `lateness`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vitrine.operators.ordering import MILESTONES, PROGRESS_STEP
from vitrine.streaming import progress
from vitrine.workspace import scratch, ship

#: Failures in a row that count as a critical error.
CRITICAL = 3
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EVENTS = "container string, run long, stage string, reached long, success long, failed long, at timestamp, reason string"
_STATE = "run long, processed long, success long, failed long, streak long, last_us long"
US = 1_000_000


class RunEvents(StatefulProcessor):
    def __init__(self, silence_seconds: float, critical: int = CRITICAL):
        self.silence = int(silence_seconds * US)
        self.critical = critical

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        data = pd.concat(list(rows)).sort_values(["ts", "id"], kind="stable")
        at = data["ts"].astype("datetime64[us]").astype(np.int64).to_numpy()
        ok = data["ok"].to_numpy(bool)
        planned = data["planned"].to_numpy(float)
        run, done, good, bad, streak, last = self.state.get() if self.state.exists() else (0, 0, 0, 0, 0, None)
        found, i = [], 0
        while i < len(at):
            if done and at[i] - last > self.silence:
                found.append((run, "completed", done, good, bad, last + self.silence, "silent"))
                done = good = bad = streak = 0
            if not done:
                run += 1
                found.append((run, "started", 0, 0, 0, at[i], None))
            gaps = np.flatnonzero(np.diff(at[i:]) > self.silence)
            end = i + int(gaps[0]) + 1 if len(gaps) else len(at)
            if planned[i] > 0:
                end = min(end, i + max(1, int(planned[i]) - done))
            part = ok[i:end]
            counts, goods = done + np.arange(1, end - i + 1), good + np.cumsum(part)
            since = np.arange(1, end - i + 1) - np.maximum.accumulate(np.where(part, np.arange(1, end - i + 1), 0))
            streaks = np.where(np.logical_or.accumulate(part), since, since + streak)
            told = np.flatnonzero((counts % PROGRESS_STEP == 0) | np.isin(counts, MILESTONES))
            found += [(run, "milestone" if counts[k] in MILESTONES else "progress", counts[k], goods[k], counts[k] - goods[k], at[i + k], None) for k in told]
            found += [(run, "errors", counts[k], goods[k], counts[k] - goods[k], at[i + k], f"{self.critical} failures in a row")
                      for k in np.flatnonzero(~part & (streaks == self.critical))]
            done, good, streak, last = int(counts[-1]), int(goods[-1]), int(streaks[-1]), int(at[end - 1])
            bad = done - good
            if planned[i] > 0 and done >= planned[i]:
                found.append((run, "completed", done, good, bad, last, "planned"))
                done = good = bad = streak = 0
            i = end
        self.state.update((run, done, good, bad, streak, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if done:
            self.handle.registerTimer((last + self.silence) // 1000 + 1)
        yield _rows(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run, done, good, bad, _, last = self.state.get()
        found = []
        if done and last + self.silence <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            found.append((run, "completed", done, good, bad, last + self.silence, "silent"))
            self.state.update((run, 0, 0, 0, 0, last))
        yield _rows(key, found)


def _rows(key, found: list[tuple]) -> pd.DataFrame:
    names = ["run", "stage", "reached", "success", "failed", "at", "reason"]
    table = pd.DataFrame(found, columns=names).astype({"run": "int64", "reached": "int64", "success": "int64", "failed": "int64"})
    table["at"] = pd.to_datetime(table["at"], unit="us")
    table.insert(0, "container", key[0])
    return table


def run_events(stream: DataFrame, container: str, ts: str, unique: str, ok: Column, silence: str, lateness: str, planned: Column | None = None,
               critical: int = CRITICAL) -> DataFrame:
    """The stream of events of all containers. `planned` is the number of items a container has to do, null where nobody knows."""
    ship(stream.sparkSession)
    seconds = pd.Timedelta(silence).total_seconds()
    items = stream.select(
        F.col(container).alias("container"), F.col(ts).alias("ts"), F.col(unique).alias("id"), ok.alias("ok"),
        (F.lit(None) if planned is None else planned).cast("double").alias("planned"),
    )
    return items.withWatermark("ts", lateness).groupBy("container").transformWithStateInPandas(
        statefulProcessor=RunEvents(seconds, critical), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime")


def follow_runs(spark: SparkSession, events: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run the stream of events over everything available, append them to `path`, and return all of them.

    Called again with the same folders it goes on where it stopped; the file sink commits each batch once, so no event comes twice.
    Keyed state with timers needs the RocksDB state store, which is set for this stream alone.
    """
    path, checkpoint = path or scratch(spark, "events"), checkpoint or scratch(spark, "stream-checkpoint")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        progress.append_stream(events, path, checkpoint)
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return spark.read.schema(events.schema).parquet(path)
