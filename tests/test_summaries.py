"""Run summaries on a small run worked out by hand."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from vitrine.operators import quality, summaries

START = datetime.datetime(2024, 1, 15, 12, 0, 0)


@pytest.fixture(scope="module")
def run(spark):
    def row(container, second, error, size):
        return (container, START + datetime.timedelta(seconds=second), error is None, error, size, 100.0, 20.0)

    data = [row("unit1", 0, None, 1000), row("unit1", 60, None, 3000), row("unit1", 90, "timeout", 0),
            row("unit1", 120, "404", 0), row("unit2", 5, None, 500)]
    return spark.createDataFrame(
        data, "container string, ts timestamp, ok boolean, error_type string, bytes long, fetch_ms double, extract_ms double")


def test_chunk_summary(run):
    one, two = summaries.chunk_summary(run).orderBy("container").collect()
    assert (one["urls_processed"], one["successful"], one["failed"], one["success_rate"]) == (4, 2, 2, 50.0)
    assert (one["elapsed_seconds"], one["urls_per_minute"]) == (120, 2.0)
    assert one["average_html_size_bytes"] == 1000 and one["error_breakdown"] == {"404": 1, "timeout": 1}
    assert (one["avg_fetch_time_ms"], one["avg_total_time_ms"]) == (100.0, 120.0)
    assert two["error_breakdown"] == {} and two["elapsed_seconds"] == 0


def test_summary_document(run, spark):
    manifest = spark.createDataFrame([("unit1", 10000, 15000)], "container string, start_index long, end_index long")
    docs = summaries.summary_documents(summaries.chunk_summary(run), manifest)
    one, two = (json.loads(r[0]) for r in docs.orderBy("container_id").select(F.to_json(F.struct("*"))).collect())
    assert (one["container_id"], one["chunk_name"], one["chunk_range"], one["success_rate"]) == ("unit1", "unit1", "10000-15000", "50.0%")
    assert one["performance_metrics"]["avg_extract_time_ms"] == 20.0
    assert two["success_rate"] == "100.0%" and "chunk_range" not in two


def test_metrics_of_nothing(spark):
    none = spark.createDataFrame([], "ok boolean, duration double, saved long, downloaded long")
    row = summaries.run_metrics(none).first()
    assert (row["total_processed"], row["p95_processing_time"], row["compression_ratio"]) == (0, None, 0)


def test_shares_add_up(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 3), (None, 4)], "k string, n long")
    assert {r["k"]: r["share"] for r in summaries.with_share(counts).collect()} == {"a": 12.5, "b": 37.5, None: 50.0}


@pytest.mark.parametrize("status, error, expected", [
    (200, None, (None, None, None)), (404, None, ("not_found", "skip", 0)), (429, None, ("rate_limit", "delay", 0)),
    (503, None, ("server_error", "retry", 3)), (None, "timeout", ("timeout", "retry", 2)), (200, "parse_error", ("parse_error", "skip", 0)),
    (None, "disk_full", ("disk_full", "abort", 0)), (None, "connection_error", ("connection_error", "retry", 3)),
    (302, None, ("unexpected_status", None, None))])
def test_fetch_classes(spark, status, error, expected):
    row = quality.classify_fetch(spark.createDataFrame([(status, error)], "status int, error string")).first()
    assert (row["error_class"], row["response"], row["retries"]) == expected


@pytest.mark.parametrize("values, expected", [
    ((0.49, 100, 5, 10), ["success_below_50"]), ((0.5, 1024, 30, 80), []),
    ((0.9, 1025, 31, 81), ["memory_above_1gb", "startup_above_30s", "cpu_above_80"])])
def test_health(spark, values, expected):
    warnings = quality.health_warnings(*[F.lit(v) for v in values])
    assert spark.range(1).select(warnings).first()[0] == expected
