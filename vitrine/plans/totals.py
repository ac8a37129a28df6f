"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import money
from vitrine.functions import urls as U
from vitrine.operators import chunks, extraction, ordering, summaries, training
from vitrine.plans import inputs as I
from vitrine.plans import pages as P
from vitrine.plans.registry import query
from vitrine.plans.urls import features_sql
from vitrine.sources.tables import read_parquet
from vitrine.workspace import stage


def _documents(spark, sf):
    return extraction.land_documents(I.document_rows(spark, sf))


def _features(spark, sf):
    return U.with_url_features(I.url_rows(spark, sf))


@query("agg_merge_stats", f"""SELECT count(*) AS files_found, count(*) FILTER (WHERE kind = 'product') AS total_products,
 count(*) FILTER (WHERE kind = 'product' AND has_price) AS with_price, count(*) FILTER (WHERE kind = 'product' AND has_materials) AS with_materials,
 count(*) FILTER (WHERE kind = 'corrupt') AS errors, count(*) FILTER (WHERE kind = 'non_object') AS non_object FROM ({I.DOCUMENTS_SQL})""")
def agg_merge_stats(spark, sf):
    return summaries.merge_statistics(_documents(spark, sf))


@query("merge_totals", f"""SELECT (SELECT count(*) FROM part) AS total_urls_processed, count(*) FILTER (WHERE kind = 'product') AS successful_extractions,
 (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT id FROM ({I.DOCUMENTS_SQL}) WHERE kind = 'product')) AS failed_extractions,
 count(*) FILTER (WHERE kind = 'product' AND has_price) AS with_price, count(*) FILTER (WHERE kind = 'corrupt') AS errors FROM ({I.DOCUMENTS_SQL})""")
def merge_totals(spark, sf):
    """Statistics of a merge beside what its manifest asked for."""
    docs = _documents(spark, sf)
    attempted = I.listings(spark, sf).select(U.product_id(F.col("url")).alias("product_id"))
    listed = summaries.attempted_totals(attempted, docs)
    return summaries.merge_statistics(docs).select(
        listed.select("total_urls_processed").scalar().alias("total_urls_processed"), F.col("total_products").alias("successful_extractions"),
        listed.select("failed_extractions").scalar().alias("failed_extractions"), "with_price", "errors")


@query("agg_category_distribution", f"""WITH c AS (SELECT category, count(*) AS n FROM ({I.DOCUMENTS_SQL}) WHERE kind = 'product' AND has_category GROUP BY 1)
 SELECT category, n, round(n * 100.0 / (SELECT sum(n) FROM c), 4) AS share FROM c""")
def agg_category_distribution(spark, sf):
    counts = summaries.distribution(_documents(spark, sf).where("kind = 'product' AND has_category"), "category")
    return summaries.with_share(counts).withColumn("share", F.round("share", 4))


def _bands_sql(source: str, labels: list[str], rule: str) -> str:
    rows = " UNION ALL ".join(f"SELECT '{label}' AS band" for label in labels)
    return (f"WITH b AS (SELECT {rule} AS band FROM ({source})), l AS ({rows}) "
            "SELECT l.band, count(b.band) AS n FROM l LEFT JOIN b ON l.band = b.band GROUP BY 1")


SQL_BAND = """CASE WHEN amount IS NULL THEN 'no_price' WHEN amount < 1000 THEN 'under_1000' WHEN amount < 5000 THEN '1000_5000'
 WHEN amount < 10000 THEN '5000_10000' WHEN amount < 50000 THEN '10000_50000' ELSE 'over_50000' END"""
SQL_BAND3 = "CASE WHEN amount < 2000 THEN 'under_2000' WHEN amount < 5000 THEN '2000_5000' ELSE 'over_5000' END"
ORDER_MONEY_SQL = f"SELECT id, {P.SQL_MONEY} AS amount FROM ({P.PRICED_SQL})"


@query("agg_price_bands", _bands_sql(ORDER_MONEY_SQL, money.PRICE_BANDS[1] + [money.NO_PRICE], SQL_BAND))
def agg_price_bands(spark, sf):
    band = money.price_band(F.col("amount"), *money.PRICE_BANDS)
    amounts = P.priced_orders(spark, sf).select(money.parse_money(F.col("price")).alias("amount"))
    return summaries.band_counts(amounts, band, money.PRICE_BANDS[1] + [money.NO_PRICE])


@query("document_price_bands", _bands_sql(f"SELECT * FROM ({I.DOCUMENTS_SQL}) WHERE kind = 'product'", money.PRICE_BANDS[1] + [money.NO_PRICE], SQL_BAND))
def document_price_bands(spark, sf):
    band = money.price_band(F.col("amount"), *money.PRICE_BANDS)
    docs = _documents(spark, sf).where("kind = 'product'")
    return summaries.band_counts(docs, band, money.PRICE_BANDS[1] + [money.NO_PRICE])


@query("agg_price_bands3", _bands_sql("SELECT round(l_extendedprice, 2) AS amount FROM lineitem", money.PRICE_BANDS_3[1], SQL_BAND3))
def agg_price_bands3(spark, sf):
    shown = money.as_dollars(F.col("l_extendedprice"))
    band = money.price_band(F.col("amount"), *money.PRICE_BANDS_3, missing=None)
    amounts = read_parquet(spark, sf, "lineitem").select(money.parse_money(shown).alias("amount"))
    return summaries.band_counts(amounts, band, money.PRICE_BANDS_3[1])


@query("agg_decade_distribution", f"""{features_sql()}, d AS (SELECT decade, count(*) AS n FROM features WHERE decade IS NOT NULL GROUP BY 1)
 SELECT decade, n, round(n * 100.0 / (SELECT sum(n) FROM d), 4) AS share FROM d""")
def agg_decade_distribution(spark, sf):
    dated = I.url_rows(spark, sf).select(U.decade(U.item_description(U.path_segments(F.col("url")))).alias("decade"))
    counts = summaries.distribution(dated.where("decade IS NOT NULL"), "decade")
    return summaries.with_share(counts).withColumn("share", F.round("share", 4))


@query("agg_chunk_summary", f"""WITH r AS ({I.RUN_SQL}), e AS (SELECT container, string_agg(error_type || '=' || n, '|' ORDER BY error_type) AS errors
 FROM (SELECT container, error_type, count(*) AS n FROM r WHERE error_type IS NOT NULL GROUP BY ALL) GROUP BY 1)
 SELECT r.container, count(*) AS urls_processed, count(*) FILTER (WHERE ok) AS successful, count(*) FILTER (WHERE NOT ok) AS failed,
 round(count(*) FILTER (WHERE ok) * 100.0 / count(*), 4) AS success_rate,
 CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS elapsed_seconds,
 round(count(*) * 60.0 / greatest(floor(epoch(max(ts))) - floor(epoch(min(ts))), 1), 6) AS urls_per_minute,
 round(avg(bytes), 4) AS average_html_size_bytes, round(sum(bytes) / 1048576.0, 4) AS total_storage_used_mb,
 coalesce(any_value(e.errors), '') AS error_breakdown, round(avg(fetch_ms), 4) AS avg_fetch_time_ms, round(avg(extract_ms), 4) AS avg_extract_time_ms,
 round(avg(fetch_ms + extract_ms), 4) AS avg_total_time_ms FROM r LEFT JOIN e ON r.container = e.container GROUP BY 1""")
def agg_chunk_summary(spark, sf):
    s = summaries.chunk_summary(I.runs(spark, sf))
    rounded = {c: F.round(c, 4) for c in ("success_rate", "average_html_size_bytes", "total_storage_used_mb",
                                          "avg_fetch_time_ms", "avg_extract_time_ms", "avg_total_time_ms")}
    return s.withColumns({**rounded, "urls_per_minute": F.round("urls_per_minute", 6),
                          "error_breakdown": P.map_text(F.col("error_breakdown"))})


METRICS = """count(*) AS total_processed, round(count(*) FILTER (WHERE ok) * 1.0 / greatest(1, count(*)), 6) AS success_rate,
 round(avg(duration) FILTER (WHERE ok), 6) AS average_processing_time,
 round(quantile_cont(duration, 0.95) FILTER (WHERE ok), 6) AS p95_processing_time,
 round(sum(saved) FILTER (WHERE ok) / greatest(1, sum(downloaded) FILTER (WHERE ok)), 6) AS compression_ratio"""
METRIC_NAMES = ["success_rate", "average_processing_time", "p95_processing_time", "compression_ratio"]


@query("agg_metrics", f"SELECT {METRICS} FROM ({I.RUN_SQL})")
def agg_metrics(spark, sf):
    return summaries.run_metrics(I.runs(spark, sf)).withColumns({c: F.round(c, 6) for c in METRIC_NAMES})


@query("agg_metrics_by_container", f"SELECT container, {METRICS} FROM ({I.RUN_SQL}) GROUP BY 1")
def agg_metrics_by_container(spark, sf):
    return summaries.run_metrics(I.runs(spark, sf), ["container"]).withColumns({c: F.round(c, 6) for c in METRIC_NAMES})


@query("agg_error_breakdown", f"""SELECT container, string_agg(error_type || '=' || n, '|' ORDER BY error_type) AS errors
 FROM (SELECT container, error_type, count(*) AS n FROM ({I.RUN_SQL}) WHERE error_type IS NOT NULL GROUP BY ALL) GROUP BY 1""")
def agg_error_breakdown(spark, sf):
    maps = summaries.count_map(I.runs(spark, sf), ["container"], "error_type", "errors")
    return maps.withColumn("errors", P.map_text(F.col("errors")))


SQL_JOBS = f"""SELECT region, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' WHEN 'signup' THEN 'completed' ELSE 'running' END AS status
 FROM (SELECT concat('region', CAST(user_id % 3 AS STRING)) AS region, event_type FROM events)"""


@query("rollup_region_status", f"""SELECT region, count(*) AS jobs, count(*) FILTER (WHERE status = 'completed') AS completed,
 count(*) FILTER (WHERE status = 'running') AS running, count(*) FILTER (WHERE status = 'failed') AS failed,
 round(count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*), 4) AS completed_pct, grouping(region) = 1 AS is_global
 FROM ({SQL_JOBS}) GROUP BY ROLLUP (region)""")
def rollup_region_status(spark, sf):
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind.isin("purchase", "signup"), "completed").otherwise("running")
    jobs = read_parquet(spark, sf, "events").select(
        F.concat(F.lit("region"), (F.col("user_id") % 3).cast("string")).alias("region"), status.alias("status"))
    return summaries.region_status(jobs).withColumn("completed_pct", F.round("completed_pct", 4))


@query("agg_corpus_quality", f"""{features_sql()} SELECT count(*) AS urls, round(avg(len(terms)), 6) AS mean_terms,
 round(avg(CASE WHEN depth_level = 5 THEN 100.0 ELSE 0.0 END), 6) AS pct_depth_5, round(avg(CASE WHEN path <> '' THEN 100.0 ELSE 0.0 END), 6) AS pct_parsed FROM features""")
def agg_corpus_quality(spark, sf):
    f = _features(spark, sf)

    def pct(c):
        return F.round(F.avg(F.when(c, 100.0).otherwise(0.0)), 6)

    return f.agg(F.count(F.lit(1)).alias("urls"), F.round(F.avg(F.size("extracted_terms")), 6).alias("mean_terms"),
                 pct(F.col("depth_level") == 5).alias("pct_depth_5"), pct(F.col("path") != "").alias("pct_parsed"))


@query("agg_images_per_product", f"""SELECT round(avg(CASE WHEN {P.SQL_HAS_NODE} THEN {P.SQL_IMAGES} ELSE 0 END), 6) AS mean_images,
 (SELECT round(avg(strlen(html)), 6) FROM pages) AS mean_page_bytes FROM part""")
def agg_images_per_product(spark, sf):
    products = extraction.extract_products(I.product_pages(spark, sf))
    size = read_parquet(spark, sf, "pages").agg(F.round(F.avg(F.octet_length("html")), 6)).scalar()
    images = products.agg(F.round(F.avg(F.size("data.images")), 6).alias("mean_images"))
    return images.withColumn("mean_page_bytes", size)


REPORT_CHUNK = 500


@query("agg_chunked_reports", f"""{features_sql(I.LISTINGS_SQL)} SELECT id // {REPORT_CHUNK} + 1 AS chunk_id, count(*) AS urls, round(avg(len(terms)), 6) AS mean_terms,
 count(decade) AS dated, count(DISTINCT secondary_category) AS categories FROM features GROUP BY 1""")
def agg_chunked_reports(spark, sf):
    f = U.with_url_features(ordering.with_position(I.listings(spark, sf), ["id"]))
    return chunks.assign_chunks(f, REPORT_CHUNK).groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("urls"), F.round(F.avg(F.size("extracted_terms")), 6).alias("mean_terms"),
        F.count("decade").alias("dated"), F.count_distinct("secondary_category").alias("categories"))


@query("agg_sample_outcome", f"""SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS success, count(*) FILTER (WHERE NOT ok) AS failed,
 round(count(*) FILTER (WHERE ok) * 100.0 / count(*), 1) AS success_rate FROM ({I.RUN_SQL})""")
def agg_sample_outcome(spark, sf):
    return summaries.run_outcome(I.runs(spark, sf), F.col("ok"))


SQL_CATEGORIES = f"{features_sql(I.LISTINGS_SQL)}, c AS (SELECT secondary_category AS category, count(*) AS n FROM features GROUP BY 1)"


def _category_counts(spark, sf):
    categories = I.listings(spark, sf).select(U.category_level(U.path_segments(F.col("url")), 1).alias("category"))
    return summaries.distribution(categories, "category")


@query("topk_categories", f"{SQL_CATEGORIES} SELECT category, n, round(n * 100.0 / (SELECT sum(n) FROM c), 4) AS share FROM c ORDER BY n DESC, category NULLS FIRST LIMIT 10")
def topk_categories(spark, sf):
    shares = summaries.with_share(_category_counts(spark, sf)).withColumn("share", F.round("share", 4))
    return summaries.top_k(shares, "category")


@query("rank_shares", f"{SQL_CATEGORIES} SELECT category, n, rank() OVER (ORDER BY n DESC) AS rank FROM c")
def rank_shares(spark, sf):
    return ordering.with_rank(_category_counts(spark, sf), "n", "category")


@query("term_count_ranks", f"""{features_sql()}, t AS (SELECT term, count(*) AS n FROM (SELECT unnest(terms) AS term FROM features) GROUP BY 1)
 SELECT term, n, rank() OVER (ORDER BY n DESC) AS rank FROM t""")
def term_count_ranks(spark, sf):
    return ordering.with_rank(stage(training.term_counts(_features(spark, sf), "extracted_terms"), "terms"), "n", "term")
