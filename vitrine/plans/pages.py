"""Queries over product pages and raw markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions import markup as M
from vitrine.functions import elements, money, text
from vitrine.operators import chunks, extraction, summaries
from vitrine.plans import inputs as I
from vitrine.plans.registry import query
from vitrine.sources.tables import read_parquet

# What each page form holds, as the check SQL sees it. Forms are described in inputs.py.
SQL_HAS_NODE = "p_partkey % 10 NOT IN (3, 4)"
SQL_NAMED = "p_partkey % 10 NOT IN (3, 4, 9)"
SQL_TITLE = f"CASE WHEN {SQL_NAMED} THEN p_name || ' ' || p_brand ELSE p_name || ' & ' || p_brand END"
SQL_DESCRIPTION = f"""CASE WHEN {SQL_NAMED} THEN 'An elegant ' || p_name || ' in walnut & ' ||
 CASE WHEN p_partkey % 2 = 0 THEN 'Brass' ELSE 'glass' END || '. Height ' || p_size || ' 1/2 x width ' || (p_size + 10) ||
 ' inches. Art Deco, made in Italy.' END"""
SQL_IMAGES = "CASE p_partkey % 10 WHEN 6 THEN 1 WHEN 7 THEN 21 ELSE 1 + p_partkey % 4 END"
SQL_IMAGE_LIST = f"""list_transform(range(1, 1 + {SQL_IMAGES}), lambda i: 'https://cdn.market.example/' || p_partkey || '_' || i || '.jpg')"""
SQL_SPAN_USD = "1000 + p_partkey % 9"
SQL_SPAN_EUR = "900 + p_partkey % 9"
SQL_PRICE = f"""CASE WHEN p_partkey % 10 IN (3, 4, 5) THEN CAST({SQL_SPAN_USD} AS VARCHAR) WHEN p_partkey % 10 = 8 THEN '0'
 ELSE CAST(p_partkey + 100 AS VARCHAR) END"""


def _pages(spark, sf):
    return I.product_pages(spark, sf)


def _products(spark, sf, *fields):
    """Extracted products with the fields that a query reads; all, if it names none."""
    return extraction.extract_products(_pages(spark, sf), fields=fields or None)


def _flat(spark, sf):
    return extraction.flatten_extracted(_products(spark, sf))


def _part(select: str) -> str:
    return f"SELECT p_partkey AS id, {select} FROM part"


def map_text(column: Column) -> Column:
    """A currency map as 'CUR=0.00' entries in key order."""
    entries = F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.array_join(entries, "|")


@query("html_jsonld_blocks", _part("CASE p_partkey % 10 WHEN 2 THEN 2 WHEN 4 THEN 0 ELSE 1 END AS blocks, "
       "CASE WHEN p_partkey % 10 = 3 THEN 1 ELSE 0 END AS broken, "
       "CASE p_partkey % 10 WHEN 1 THEN 1 WHEN 3 THEN 0 WHEN 4 THEN 0 ELSE 2 END AS nodes"))
def html_jsonld_blocks(spark, sf):
    t = _pages(spark, sf).withColumn("t", M.jsonld_texts(F.col("html")))
    return t.select("id", F.size("t").alias("blocks"), M.broken_blocks(F.col("t")).alias("broken"),
                    F.size(M.jsonld_nodes(F.col("t"))).alias("nodes"))


@query("jsonld_select_type", _part(f"{SQL_HAS_NODE} AS has_product, p_partkey % 10 NOT IN (1, 3, 4) AS has_breadcrumb"))
def jsonld_select_type(spark, sf):
    p = extraction.parse_pages(_pages(spark, sf))
    return p.select("id", F.col("_product").isNotNull().alias("has_product"), F.col("_crumbs").isNotNull().alias("has_breadcrumb"))


@query("product_title", _part(f"{SQL_TITLE} AS title"))
def product_title(spark, sf):
    p = extraction.parse_pages(_pages(spark, sf))
    return p.select("id", M.title(F.col("_product"), F.col("html")).alias("title"))


@query("product_description", _part(f"{SQL_DESCRIPTION} AS description"))
def product_description(spark, sf):
    p = extraction.parse_pages(_pages(spark, sf))
    return p.select("id", M.description(F.col("_product")).alias("description"))


@query("product_brand", _part(f"CASE WHEN {SQL_HAS_NODE} THEN p_brand END AS brand"))
def product_brand(spark, sf):
    p = extraction.parse_pages(_pages(spark, sf))
    return p.select("id", M.brand(F.col("_product")).alias("brand"))


@query("product_availability", _part("CASE WHEN p_partkey % 10 IN (3, 4, 5) THEN NULL WHEN p_partkey % 10 = 8 THEN 'OutOfStock' "
       "ELSE 'InStock' END AS availability"))
def product_availability(spark, sf):
    p = extraction.parse_pages(_pages(spark, sf))
    return p.select("id", M.availability(F.col("_offers")).alias("availability"))


@query("spec_period", _part(f"CASE WHEN {SQL_HAS_NODE} THEN (1900 + p_partkey % 10 * 10) || 's' ELSE '1960s' END AS period, true AS is_period"))
def spec_period(spark, sf):
    return _products(spark, sf, "period").select("id", "data.specifications.period", M.is_period(F.col("data.specifications.period")).alias("is_period"))


@query("spec_category", _part(f"CASE WHEN {SQL_HAS_NODE} THEN p_type END AS category"))
def spec_category(spark, sf):
    return _products(spark, sf).select("id", "data.specifications.category")


@query("spec_condition", _part(f"CASE WHEN {SQL_HAS_NODE} THEN 'Used' ELSE 'Good' END AS condition, "
       f"CASE WHEN {SQL_HAS_NODE} THEN 'UsedCondition' ELSE 'Good' END AS condition_raw"))
def spec_condition(spark, sf):
    return _products(spark, sf, "condition", "condition_raw").select("id", "data.specifications.condition", "data.specifications.condition_raw")


@query("spec_dimensions", _part(f"CASE WHEN {SQL_NAMED} THEN p_size || ' 1/2 inches' END AS height, "
       f"CASE WHEN {SQL_NAMED} THEN (p_size + 10) || ' inches' END AS width, CAST(NULL AS VARCHAR) AS depth"))
def spec_dimensions(spark, sf):
    return _products(spark, sf, "dimensions").select("id", "data.specifications.dimensions.*")


@query("spec_materials", _part(f"CASE WHEN NOT {SQL_NAMED} THEN '' WHEN p_partkey % 2 = 0 THEN 'Walnut, Brass' "
       "ELSE 'Walnut, Glass' END AS materials"))
def spec_materials(spark, sf):
    return _products(spark, sf).select("id", F.array_join("data.specifications.materials", ", ").alias("materials"))


@query("document_materials", "SELECT doc_id, " + " || ".join(
    f"CASE WHEN regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_]){m}($|[^\\p{{L}}\\p{{N}}_])') THEN '{m.capitalize()},' ELSE '' END" for m in M.MATERIALS + ["in", "der"]
) + " AS materials FROM documents")
def document_materials(spark, sf):
    found = M.materials(F.col("text"), M.MATERIALS + ["in", "der"])
    return read_parquet(spark, sf, "documents").select(
        "doc_id", F.array_join(F.transform(found, lambda m: F.concat(m, F.lit(","))), "").alias("materials")
    )


@query("spec_style_origin", _part(f"CASE WHEN {SQL_NAMED} THEN 'Art Deco' END AS style, 'France' AS origin"))
def spec_style_origin(spark, sf):
    return _products(spark, sf, "style", "origin").select("id", "data.specifications.style", "data.specifications.origin")


@query("html_detail_list", _part("CASE WHEN p_partkey % 3 = 1 THEN 4 ELSE 3 END AS entries, '1960s' AS period, 'France' AS place"))
def html_detail_list(spark, sf):
    d = _pages(spark, sf).select("id", M.detail_list(F.col("html")).alias("d"))
    return d.select("id", F.size("d").alias("entries"), F.col("d")["Period"].alias("period"), F.col("d")["Place of Origin"].alias("place"))


@query("html_price_spans", _part(f"'EUR=' || ({SQL_SPAN_EUR}) || '.00|USD=' || ({SQL_SPAN_USD}) || '.00' AS prices"))
def html_price_spans(spark, sf):
    return _pages(spark, sf).select("id", map_text(M.price_spans(F.col("html"))).alias("prices"))


@query("pricing_multi_currency", _part(f"""CASE WHEN p_partkey % 10 IN (3, 4, 5) THEN 'EUR=' || ({SQL_SPAN_EUR}) || '.00|USD=' || ({SQL_SPAN_USD}) || '.00'
 WHEN p_partkey % 10 = 6 THEN 'USD=' || (p_partkey + 100) || '.00' WHEN p_partkey % 10 = 8 THEN 'USD=0.00'
 ELSE 'EUR=' || (p_partkey + 90) || '.25|USD=' || (p_partkey + 100) || '.00' END AS amounts"""))
def pricing_multi_currency(spark, sf):
    return _products(spark, sf).select("id", map_text(F.col("data.pricing.multi_currency")).alias("amounts"))


@query("pricing_usd", _part(f"{SQL_PRICE} AS price, 'USD' AS currency"))
def pricing_usd(spark, sf):
    return _products(spark, sf, "price", "currency").select("id", "data.pricing.price", "data.pricing.currency")


@query("image_urls", _part(f"CASE WHEN {SQL_HAS_NODE} THEN array_to_string({SQL_IMAGE_LIST}, '|') ELSE '' END AS images"))
def image_urls(spark, sf):
    return _products(spark, sf).select("id", F.array_join("data.images", "|").alias("images"))


@query("breadcrumb", _part("CASE WHEN p_partkey % 10 IN (1, 3, 4) THEN 'Home > Furniture' ELSE 'Home > ' || p_type END AS breadcrumb"))
def breadcrumb(spark, sf):
    return _products(spark, sf).select("id", F.array_join("data.category_breadcrumb", " > ").alias("breadcrumb"))


@query("extract_products", _part(f"""CASE WHEN p_partkey % 10 = 3 THEN 'failed' ELSE 'success' END AS extraction_status,
 CASE WHEN p_partkey % 10 = 3 THEN 'parse_error' END AS failure_reason, 'f_' || p_partkey AS product_id, {SQL_TITLE} AS title,
 {SQL_DESCRIPTION} AS description, {SQL_PRICE} AS price, CASE WHEN {SQL_HAS_NODE} THEN p_type END AS category,
 CASE WHEN {SQL_HAS_NODE} THEN {SQL_IMAGES} ELSE 0 END AS images"""))
def extract_products(spark, sf):
    return _products(spark, sf, "product_id", "title", "description", "price", "category", "images").select(
        "id", "extraction_status", "failure_reason", "data.product_info.product_id", "data.product_info.title",
        "data.product_info.description", "data.pricing.price", "data.specifications.category",
        F.size("data.images").alias("images"),
    )


@query("extraction_envelope", _part("""'unit1' AS container_id, 'f_' || p_partkey AS product_id, '1.0.0' AS extractor_version,
 p_size * 1 AS extraction_duration_ms, CASE WHEN p_partkey % 10 = 3 THEN 'failed' ELSE 'success' END AS extraction_status,
 true AS has_size"""))
def extraction_envelope(spark, sf):
    size = read_parquet(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size")
    products = _products(spark, sf).join(size, "id")
    meta = extraction.envelope(products.drop("id"), F.lit("unit1"), F.current_timestamp(), F.col("p_size"))
    return meta.select(
        F.regexp_extract("extraction_metadata.product_id", r"(\d+)", 1).cast("long").alias("id"),
        "extraction_status", "extraction_metadata.container_id", "extraction_metadata.product_id",
        "extraction_metadata.extractor_version", "extraction_metadata.extraction_duration_ms",
        (F.col("extraction_metadata.html_size_bytes") > 0).alias("has_size"),
    )


@query("flatten_product", "SELECT id, kind, product_id, category, has_price, has_materials FROM (" + I.DOCUMENTS_SQL + ") WHERE kind = 'product'")
def flatten_product(spark, sf):
    docs = extraction.land_documents(I.document_rows(spark, sf))
    return docs.where("kind = 'product'").select(
        F.substring("product_id", 3, 20).cast("long").alias("id"), "kind", "product_id", "category", "has_price", "has_materials"
    )


SQL_SANITIZED = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
 '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), 'on\w+="[^"]*"', '', 'g'), '<[^>]*>', '', 'g')"""


SQL_UNESCAPED = SQL_SANITIZED
for _ref, _char in [("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]:
    SQL_UNESCAPED = f"replace({SQL_UNESCAPED}, '{_ref}', '{_char}')"


@query("sanitize_strings", rf"SELECT page_id, md5(regexp_replace({SQL_UNESCAPED}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g')) AS text_md5 FROM pages")
def sanitize_strings(spark, sf):
    clean = text.sanitize_strings(read_parquet(spark, sf, "pages").select("page_id", F.struct(F.array("html").alias("texts")).alias("data")))
    return clean.select("page_id", F.md5(F.col("data.texts")[0]).alias("text_md5"))


# Scripts, styles and comments gone, then the markup of one element, cut at its end.
SQL_SHOWN = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', ' ', 'g'), '(?s)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')"


def _sql_texts(start: str, end: str) -> str:
    """Visible texts of the elements that begin at a plain start tag and end before the next match of `end`."""
    piece = f"regexp_replace(x, '(?s)({end}).*$', '')"
    plain = f"regexp_replace({piece}, '<[^>]*>', ' ', 'g')"
    for ref, char in [("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]:
        plain = f"replace({plain}, '{ref}', '{char}')"
    return f"list_transform(string_split({SQL_SHOWN}, '{start}')[2:], lambda x: trim(regexp_replace({plain}, '\\s+', ' ', 'g')))"


@query("page_elements", f"""WITH e AS (SELECT page_id, {_sql_texts('<li>', '</li>')} AS items, {_sql_texts('<p>', '</p>|</article>')} AS paragraphs,
  regexp_extract_all({SQL_SHOWN}, '<a href="([^"]*)">', 1) AS targets, {_sql_texts('<a ', '</a>')} AS labels FROM pages)
 SELECT page_id, len(items) AS items, md5(array_to_string(items, '|')) AS items_md5, len(paragraphs) AS paragraphs, md5(array_to_string(paragraphs, '|')) AS paragraphs_md5,
  len(targets) AS links, md5(array_to_string(list_transform(range(1, 1 + len(targets)), lambda i: targets[i] || '=' || regexp_replace(labels[i], '^href="[^"]*">', '')), '|')) AS links_md5 FROM e""")
def page_elements(spark, sf):
    """List items, paragraphs and links of the raw pages, whose tags are partly unclosed."""
    h = F.col("html")
    found = read_parquet(spark, sf, "pages").select(
        "page_id", elements.list_items(h).alias("i"), elements.paragraphs(h).alias("p"),
        F.transform(elements.links(h), lambda a: F.concat_ws("=", a["href"], a["text"])).alias("a"))
    return found.select("page_id", *[x for name, c in (("items", "i"), ("paragraphs", "p"), ("links", "a"))
                                     for x in (F.size(c).cast("long").alias(name), F.md5(F.array_join(c, "|")).alias(f"{name}_md5"))])


PRICED_SQL = "SELECT o_orderkey AS id, " + I.PRICE_TEXT_CASES.format(
    key="o_orderkey", shown="'$' || printf('%,.2f', o_totalprice)") + " AS price, o_totalprice FROM orders"
SQL_MONEY = "CASE CAST(id % 17 AS INT) WHEN 3 THEN NULL WHEN 5 THEN NULL WHEN 7 THEN NULL WHEN 9 THEN NULL WHEN 11 THEN 0.0 WHEN 13 THEN NULL WHEN 15 THEN NULL ELSE round(o_totalprice, 2) END"


def priced_orders(spark, sf):
    shown = "concat('$', format_number(o_totalprice, 2))"
    return read_parquet(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr(I.PRICE_TEXT_CASES.format(key="o_orderkey", shown=shown)).alias("price")
    )


@query("parse_money", f"SELECT id, CAST({SQL_MONEY} AS DOUBLE) AS amount FROM ({PRICED_SQL})")
def parse_money(spark, sf):
    return priced_orders(spark, sf).select("id", F.round(money.parse_money(F.col("price")), 2).alias("amount"))


@query("content_checksum", "SELECT page_id, sha256(html) AS checksum FROM pages")
def content_checksum(spark, sf):
    return read_parquet(spark, sf, "pages").select("page_id", F.sha2("html", 256).alias("checksum"))


@query("compression_ratio", f"SELECT round(sum(saved) / greatest(1, sum(downloaded)), 6) AS ratio FROM ({I.RUN_SQL}) WHERE ok")
def compression_ratio(spark, sf):
    ok = I.runs(spark, sf).where("ok")
    return ok.agg(F.round(summaries.compression_ratio(F.col("saved"), F.col("downloaded")), 6).alias("ratio"))


@query("chunk_number_padded", "SELECT p_partkey AS id, printf('urls_chunk_%04d.txt', p_partkey + 1) AS filename FROM part")
def chunk_number_padded(spark, sf):
    return I.listings(spark, sf).select("id", chunks.chunk_file_name(F.col("id") + 1).alias("filename"))


@query("chunk_id_from_name", "SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS chunk_id FROM part")
def chunk_id_from_name(spark, sf):
    named = I.listings(spark, sf).withColumn("name", F.concat(F.lit("worker-chunk-"), F.col("id").cast("string")))
    return named.select("id", chunks.chunk_number(F.col("name"), "worker-chunk-").alias("chunk_id"))
