"""Windows that close: append mode behind a watermark, with the rows that came too late in a table of their own.

Spark drops late rows silently. So a first stream parts each batch by a watermark of its own (the latest time of all earlier batches less the
lateness, kept in a ledger of one row a batch) and writes both sides; rows whose window had ended by then are late. A second stream
aggregates the rows that were in time under `withWatermark`. Its watermark never runs ahead of the ledger's, so it drops nothing, and a
closed window is final.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.ordering import discrete_percentiles
from vitrine.sources.files import exists
from vitrine.streaming import progress
from vitrine.workspace import scratch, stage


class LateRows:
    """Parts each batch into rows in time and late ones. A repeated batch finds its own files and changes nothing."""

    def __init__(self, spark: SparkSession, path: str, ts: str, width: str, lateness: str):
        self.spark, self.path, self.ts, self.width = spark, path, ts, width
        self.lateness = F.expr(f"INTERVAL '{pd.Timedelta(lateness).total_seconds():.6f}' SECOND")

    def _ledger(self, batch_id: int) -> str:
        return f"{self.path}/ledger/batch={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = f"{self.path}/rows/batch={batch_id}"
        latest = None
        if batch_id:
            latest = self.spark.read.parquet(self._ledger(batch_id - 1)).first()["latest"]
        if not exists(self.spark, f"{rows}/_SUCCESS"):
            end = F.window(self.ts, self.width)["end"]
            late = F.lit(False) if latest is None else F.coalesce(end <= F.lit(latest) - self.lateness, F.lit(False))
            batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(rows)
        if not exists(self.spark, f"{self._ledger(batch_id)}/_SUCCESS"):
            written = self.spark.read.schema(batch.schema.add("late", "boolean")).parquet(rows)
            newest = F.greatest(F.max(self.ts), F.lit(latest).cast("timestamp"))
            ledger = written.agg(newest.alias("latest"), F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late_rows"))
            ledger.write.mode("overwrite").parquet(self._ledger(batch_id))

    def late(self, schema) -> DataFrame:
        """The late rows, with the batch they came in."""
        rows = self.spark.read.schema(schema.add("late", "boolean").add("batch", "long")).option("basePath", f"{self.path}/rows")
        return rows.parquet(f"{self.path}/rows").where("late").drop("late")

    def ledger(self) -> DataFrame:
        """One row for each batch: the latest time so far, its rows and its late rows."""
        return self.spark.read.parquet(f"{self.path}/ledger")

    def in_time(self, schema, files_per_batch: int | None = None) -> DataFrame:
        """A stream of the rows that were in time, in the order of their batches."""
        return progress.read_stream(self.spark, f"{self.path}/rows/batch=*/late=false", schema, files_per_batch=files_per_batch)


def closed_counts(stream: DataFrame, ts: str, width: str, lateness: str, value: str, ok: Column) -> DataFrame:
    """Counts of each closed window and value, in append mode: rows leave the state when the watermark passes their window."""
    grouped = stream.withWatermark(ts, lateness).groupBy(F.window(ts, width).alias("w"), F.col(value).alias("value"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok")).select(F.col("w.start").alias("window_start"), "value", "n", "n_ok")


def window_figures(counts: DataFrame) -> DataFrame:
    """Items, rates and exact time percentiles of windows from their counts by value."""
    n, good = F.sum("n"), F.sum("n_ok")
    windows = counts.groupBy("window_start").agg(n.alias("urls"), (good / n).alias("success_rate"), ((n - good) / n).alias("failure_rate"))
    times = discrete_percentiles(counts, "window_start", "value", "n", {"p50": 50, "p95": 95})
    return windows.join(times, "window_start", "left")


def follow_closed_windows(
    spark: SparkSession, stream: DataFrame, ts: str, ok: Column, duration: str, width: str, lateness: str, path: str | None = None,
) -> tuple[DataFrame, LateRows]:
    """Figures of all windows closed so far, and the late rows. Called again with the same `path`, it goes on where it stopped."""
    path = path or scratch(spark, "windows")
    late = LateRows(spark, f"{path}/split", ts, width, lateness)
    progress.run_to_end(stream, f"{path}/split-checkpoint", late, "append")
    counts = closed_counts(late.in_time(stream.schema, files_per_batch=16), ts, width, lateness, duration, ok)
    progress.append_stream(counts, f"{path}/closed", f"{path}/closed-checkpoint")
    closed = stage(spark.read.schema(counts.schema).parquet(f"{path}/closed"), "closed")
    return window_figures(closed), late
