"""Queries that filter, classify and validate."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import extraction, matching, quality
from vitrine.plans import inputs as I
from vitrine.plans import pages as P
from vitrine.plans.registry import query
from vitrine.sources.tables import read_parquet

SQL_HOST = I.HOST.replace(".", r"\.")
PAGE_LOW, PAGE_HIGH = 2_000, 20_000


@query("filter_valid_url", rf"WITH u AS ({I.CANDIDATES_SQL}) SELECT id, url FROM u WHERE regexp_matches(url, '^https://{SQL_HOST}/.*/id-f_\d+/')")
def filter_valid_url(spark, sf):
    return I.candidates(spark, sf).where(quality.is_listing_url(F.col("url"), I.HOST))


@query("sanitize_url", rf"""WITH u AS ({I.CANDIDATES_SQL}) SELECT id, CASE WHEN NOT starts_with(lower(url), 'https://') THEN 'scheme'
 WHEN regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) <> '{I.HOST}' THEN 'host'
 WHEN NOT regexp_matches(url, '/id-f_\d+/') THEN 'no id'
 WHEN contains(url, '..') OR contains(substr(url, 9), '//') THEN 'path' END AS reject_reason FROM u""")
def sanitize_url(spark, sf):
    return I.candidates(spark, sf).select("id", quality.url_reject_reason(F.col("url"), I.HOST).alias("reject_reason"))


@query("filter_content", f"""SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'status' WHEN page_id % 13 = 0 THEN 'content_type'
 WHEN strlen(html) < {PAGE_LOW} THEN 'too_small' WHEN strlen(html) > {PAGE_HIGH} THEN 'too_large' END AS reject_reason FROM pages""")
def filter_content(spark, sf):
    key = F.col("page_id")
    reason = quality.content_reject_reason(
        F.when(key % 11 == 0, F.lit(404)).otherwise(F.lit(200)),
        F.when(key % 13 == 0, F.lit("application/pdf")).otherwise(F.lit("text/html; charset=utf-8")),
        F.octet_length("html"), PAGE_LOW, PAGE_HIGH,
    )
    return read_parquet(spark, sf, "pages").select("page_id", reason.alias("reject_reason"))


@query("classify_fetch", f"""WITH o AS (SELECT event_id, CASE WHEN error_type IN ('timeout', 'parse_error') THEN error_type WHEN event_id % 7 = 1 THEN 'not_found'
 WHEN event_id % 7 = 2 THEN 'rate_limit' WHEN event_id % 7 = 3 THEN 'server_error' WHEN event_id % 7 = 4 THEN 'unexpected_status' END AS error_class
 FROM ({I.RUN_SQL})) SELECT event_id, error_class,
 CASE error_class WHEN 'timeout' THEN 'retry' WHEN 'parse_error' THEN 'skip' WHEN 'not_found' THEN 'skip' WHEN 'rate_limit' THEN 'delay' WHEN 'server_error' THEN 'retry' END AS response,
 CASE error_class WHEN 'timeout' THEN 2 WHEN 'parse_error' THEN 0 WHEN 'not_found' THEN 0 WHEN 'rate_limit' THEN 0 WHEN 'server_error' THEN 3 END AS retries,
 CASE error_class WHEN 'timeout' THEN 'WARN' WHEN 'parse_error' THEN 'ERROR' WHEN 'not_found' THEN 'WARN' WHEN 'rate_limit' THEN 'WARN' WHEN 'server_error' THEN 'ERROR' END AS log_level FROM o""")
def classify_fetch(spark, sf):
    m = F.col("event_id") % 7
    status = F.when(m == 1, 404).when(m == 2, 429).when(m == 3, 503).when(m == 4, 302).otherwise(200)
    error = F.when(F.col("error_type").isin("timeout", "parse_error"), F.col("error_type"))
    outcomes = I.runs(spark, sf).select("event_id", status.alias("status"), error.alias("error"))
    return quality.classify_fetch(outcomes).select("event_id", "error_class", "response", "retries", "log_level")


@query("validate_product", f"""SELECT p_partkey AS id, CASE WHEN p_partkey % 10 = 7 THEN 'too_many_images'
 WHEN p_partkey % 10 = 8 THEN 'price_range' ELSE '' END AS failures FROM part""")
def validate_product(spark, sf):
    d = F.col("data")
    failures = quality.product_failures(
        d["product_info"].isNotNull(), d["product_info"]["product_id"], d["images"],
        d["pricing"]["multi_currency"], d["pricing"]["price"], d["product_info"]["title"], d["product_info"]["description"],
    )
    read = ["product_id", "title", "description", "multi_currency", "price", "images"]
    products = extraction.extract_products(I.product_pages(spark, sf), fields=read)
    return products.select("id", F.array_join(failures, "|").alias("failures"))


@query("validate_required", f"""SELECT id, concat_ws('|', CASE WHEN id % 4 = 3 THEN 'title' END,
 CASE WHEN has_price THEN NULL ELSE 'price' END) AS failures FROM ({I.DOCUMENTS_SQL}) WHERE kind = 'product'""")
def validate_required(spark, sf):
    docs = extraction.land_documents(I.document_rows(spark, sf)).where("kind = 'product'")
    key = F.substring("product_id", 3, 20).cast("long")
    title = F.when(key % 4 == 3, F.lit("")).otherwise(F.col("title"))
    return docs.select(key.alias("id"), F.array_join(
        quality.required_failures(F.col("product_id"), title, F.col("price")), "|").alias("failures"))


@query("filter_key_present", f"SELECT id FROM ({I.DOCUMENTS_SQL}) WHERE kind = 'product' AND has_price AND has_materials AND category IS NOT NULL")
def filter_key_present(spark, sf):
    docs = extraction.land_documents(I.document_rows(spark, sf))
    kept = docs.where(F.col("has_price") & F.col("has_materials") & quality.truthy(F.col("category")))
    return kept.select(F.substring("product_id", 3, 20).cast("long").alias("id"))


@query("check_no_overlap", f"""SELECT user_id, count(DISTINCT container) AS owners FROM (SELECT user_id,
 CASE WHEN user_id % 10 = 0 AND event_id % 2 = 0 THEN 'spare' ELSE container END AS container FROM ({I.RUN_SQL})) GROUP BY 1 HAVING count(DISTINCT container) > 1""")
def check_no_overlap(spark, sf):
    owner = F.when((F.col("user_id") % 10 == 0) & (F.col("event_id") % 2 == 0), F.lit("spare")).otherwise(F.col("container"))
    assigned = I.runs(spark, sf).select("user_id", owner.alias("owner"))
    return matching.overlaps(assigned, "user_id", "owner")


@query("chunk_health_flags", f"""WITH s AS (SELECT user_id, count(*) FILTER (WHERE ok) * 1.0 / count(*) AS rate, avg(duration) * 8 AS mem,
 avg(duration) AS startup, max(duration) / 5 AS cpu FROM ({I.RUN_SQL}) GROUP BY 1) SELECT user_id,
 concat_ws('|', CASE WHEN rate < 0.5 THEN 'success_below_50' END, CASE WHEN mem > 1024 THEN 'memory_above_1gb' END,
 CASE WHEN startup > 30 THEN 'startup_above_30s' END, CASE WHEN cpu > 80 THEN 'cpu_above_80' END) AS warnings FROM s""")
def chunk_health_flags(spark, sf):
    s = I.runs(spark, sf).groupBy("user_id").agg(
        (F.count_if("ok") / F.count(F.lit(1))).alias("rate"), (F.avg("duration") * 8).alias("mem"),
        F.avg("duration").alias("startup"), (F.max("duration") / 5).alias("cpu"),
    )
    flags = quality.health_warnings(F.col("rate"), F.col("mem"), F.col("startup"), F.col("cpu"))
    return s.select("user_id", F.array_join(flags, "|").alias("warnings"))


@query("pii_free_projection", f"""SELECT 'f_' || p_partkey AS product_id, CASE WHEN {P.SQL_HAS_NODE} THEN p_type END AS category,
 CASE WHEN {P.SQL_HAS_NODE} THEN 'Used' ELSE 'Good' END AS condition FROM part""")
def pii_free_projection(spark, sf):
    read = ["product_id", "title", "brand", "price", "multi_currency", "category", "condition"]
    flat = extraction.flatten_extracted(extraction.extract_products(I.product_pages(spark, sf), fields=read))
    return quality.without_private(flat.select(*read))
