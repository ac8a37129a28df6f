"""Counts, shares, bands and run summaries. Each is one pass with partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import money
from vitrine.operators.ordering import exact_percentile


def distribution(df: DataFrame, by: str, count: str = "n") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(count))


def with_share(counts: DataFrame, count: str = "n", name: str = "share") -> DataFrame:
    """Add each row's percentage of the whole; the total is a scalar subquery over the aggregate."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(name, F.col(count) * 100.0 / total)


def top_k(counts: DataFrame, by: str, k: int = 10, count: str = "n") -> DataFrame:
    """The k largest; equal counts in name order."""
    return counts.orderBy(F.col(count).desc(), F.col(by)).limit(k)


def band_counts(df: DataFrame, band: Column, labels: Sequence[str], name: str = "band") -> DataFrame:
    """Rows per label, with the empty labels as 0: one global aggregate, then one row per label."""
    counted = df.select(band.alias("_band")).agg(
        *[F.count_if(F.col("_band") == label).alias(f"_{i}") for i, label in enumerate(labels)]
    )
    rows = F.array(*[F.struct(F.lit(lab).alias(name), F.col(f"_{i}").alias("n")) for i, lab in enumerate(labels)])
    return counted.select(F.inline(rows))


def count_map(df: DataFrame, by: Sequence[str], key: str, name: str) -> DataFrame:
    """Per group, a map from each value of `key` to its count. Counted first, then gathered."""
    counts = df.where(F.col(key).isNotNull()).groupBy(*by, key).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.sort_array(F.collect_list(F.struct(key, "_n")))
    return counts.groupBy(*by).agg(F.map_from_entries(pairs).alias(name))


def merge_statistics(documents: DataFrame) -> DataFrame:
    """Totals of a merge, from documents labelled by kind."""
    product = F.col("kind") == "product"
    return documents.agg(
        F.count(F.lit(1)).alias("files_found"),
        F.count_if(product).alias("total_products"),
        F.count_if(product & F.col("has_price")).alias("with_price"),
        F.count_if(product & F.col("has_materials")).alias("with_materials"),
        F.count_if(F.col("kind") == "corrupt").alias("errors"),
        F.count_if(F.col("kind") == "non_object").alias("non_object"),
    )


SUMMARY_SCHEMA = """chunks_processed long, instances_used long, total_urls_processed long, successful_extractions long, failed_extractions long,
 files_found long, errors long, category_distribution map<string,long>, price_ranges map<string,long>"""
CHUNK_SUMMARY_SCHEMA = """container_id string, chunk_name string, urls_processed long, successful long, failed long, chunk_range string, success_rate string,
 elapsed_seconds long, urls_per_minute double, average_html_size_bytes double, total_storage_used_mb double, error_breakdown map<string,long>,
 performance_metrics struct<avg_fetch_time_ms:double,avg_extract_time_ms:double,avg_total_time_ms:double>"""


def attempted_totals(attempted: DataFrame, documents: DataFrame, key: str = "product_id") -> DataFrame:
    """One row: how many listed ids were to be fetched, and how many of them have no product. Products come down to their ids first."""
    found = documents.where("kind = 'product'").select(key).distinct()
    missing = attempted.join(found, key, "left_anti").agg(F.count(F.lit(1)).alias("failed_extractions"))
    return attempted.agg(F.count(F.lit(1)).alias("total_urls_processed")).withColumn("failed_extractions", missing.scalar())


def run_summary(attempted: DataFrame, documents: DataFrame, key: str = "product_id") -> DataFrame:
    """The one document that sums up a run: instances, chunks, attempted and failed URLs, categories and price bands.

    documents: parsed and flattened ones with `instance` and `chunk`; attempted: the ids of the manifest. The map of categories
    has an entry for each category that is named, as the document lists them all; the distribution itself is `distribution`.
    """
    product = F.col("kind") == "product"
    labels = [*money.PRICE_BANDS[1], money.NO_PRICE]
    band = money.price_band(F.col("amount"), *money.PRICE_BANDS)
    totals = documents.agg(
        F.count_distinct("instance", "chunk").alias("chunks_processed"), F.count_distinct("instance").alias("instances_used"),
        F.count_if(product).alias("successful_extractions"), F.count(F.lit(1)).alias("files_found"), F.count_if(F.col("kind") == "corrupt").alias("errors"),
        F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*[F.count_if(product & (band == label)) for label in labels])).alias("price_ranges"),
    )
    counts = distribution(documents.where(product & F.col("category").isNotNull()), "category")
    categories = counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("category", "n")))).alias("m"))
    listed = attempted_totals(attempted, documents, key)
    return totals.withColumns({
        "category_distribution": categories.scalar(), "total_urls_processed": listed.select("total_urls_processed").scalar(),
        "failed_extractions": listed.select("failed_extractions").scalar(),
    })


def run_outcome(rows: DataFrame, ok: Column) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failed"),
        F.round(F.count_if(ok) * 100.0 / F.count(F.lit(1)), 1).alias("success_rate"),
    )


def chunk_summary(rows: DataFrame, chunk: str = "container") -> DataFrame:
    """One row per chunk from rows (ts, ok, error_type, bytes, fetch_ms, extract_ms).

    The first level groups by chunk and error type, so the error map and all totals
    come from the same single scan.
    """
    level1 = rows.groupBy(chunk, "error_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("ok").alias("ok"),
        F.min("ts").alias("t0"),
        F.max("ts").alias("t1"),
        F.sum("bytes").alias("bytes"),
        F.sum("fetch_ms").alias("fetch"),
        F.sum("extract_ms").alias("extract"),
    )
    failed = F.filter(F.sort_array(F.collect_list(F.struct("error_type", "n"))), lambda e: e["error_type"].isNotNull())
    n = F.sum("n")
    seconds = F.unix_timestamp(F.max("t1")) - F.unix_timestamp(F.min("t0"))
    return level1.groupBy(chunk).agg(
        n.alias("urls_processed"),
        F.sum("ok").alias("successful"),
        (n - F.sum("ok")).alias("failed"),
        (F.sum("ok") * 100.0 / F.greatest(n, F.lit(1))).alias("success_rate"),
        seconds.alias("elapsed_seconds"),
        (n * 60.0 / F.greatest(seconds, F.lit(1))).alias("urls_per_minute"),
        (F.sum("bytes") / n).alias("average_html_size_bytes"),
        (F.sum("bytes") / F.lit(1048576.0)).alias("total_storage_used_mb"),
        F.map_from_entries(failed).alias("error_breakdown"),
        (F.sum("fetch") / n).alias("avg_fetch_time_ms"),
        (F.sum("extract") / n).alias("avg_extract_time_ms"),
        ((F.sum("fetch") + F.sum("extract")) / n).alias("avg_total_time_ms"),
    )


def percent_text(value: Column) -> Column:
    """99.0 as '99.0%'."""
    return F.concat(F.format_string("%.1f", value), F.lit("%"))


def summary_documents(summary: DataFrame, manifest: DataFrame, chunk: str = "container") -> DataFrame:
    """Chunk summaries in their exported form, with the range of list positions from the manifest."""
    span = F.concat_ws("-", F.col("start_index").cast("string"), F.col("end_index").cast("string"))
    ranges = manifest.select(chunk, span.alias("chunk_range"))
    times = ["avg_fetch_time_ms", "avg_extract_time_ms", "avg_total_time_ms"]
    return summary.join(ranges, chunk, "left").select(
        F.col(chunk).alias("container_id"),
        F.col(chunk).alias("chunk_name"),
        "urls_processed", "successful", "failed", "chunk_range",
        percent_text(F.col("success_rate")).alias("success_rate"),
        "elapsed_seconds", "urls_per_minute", "average_html_size_bytes", "total_storage_used_mb", "error_breakdown",
        F.struct(*times).alias("performance_metrics"),
    )


def run_metrics(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Success rate, mean and exact 95th percentile of success times, and bytes saved per byte downloaded."""
    n = F.count(F.lit(1))
    spent = F.when(F.col("ok"), F.col("duration"))
    totals = rows.groupBy(*by).agg(
        n.alias("total_processed"),
        (F.count_if("ok") / F.greatest(n, F.lit(1))).alias("success_rate"),
        F.avg(spent).alias("average_processing_time"),
        compression_ratio(F.when(F.col("ok"), F.col("saved")), F.when(F.col("ok"), F.col("downloaded"))).alias(
            "compression_ratio"
        ),
    )
    p95 = exact_percentile(rows.where("ok"), by, "duration", 0.95, "p95_processing_time")
    if by:
        return totals.join(p95, list(by), "left")
    return totals.withColumn("p95_processing_time", p95.scalar())


def compression_ratio(saved: Column, downloaded: Column) -> Column:
    total = F.coalesce(F.sum(downloaded), F.lit(0))
    return F.coalesce(F.sum(saved), F.lit(0)) / F.greatest(total, F.lit(1))


def region_status(jobs: DataFrame, region: str = "region", status: str = "status") -> DataFrame:
    """Jobs by status per region with a global row."""
    s = F.col(status)
    n = F.count(F.lit(1))
    return jobs.rollup(region).agg(
        n.alias("jobs"),
        F.count_if(s == "completed").alias("completed"),
        F.count_if(s == "running").alias("running"),
        F.count_if(s == "failed").alias("failed"),
        (F.count_if(s == "completed") * 100.0 / n).alias("completed_pct"),
        (F.grouping(region) == 1).alias("is_global"),
    )
