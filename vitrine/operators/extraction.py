"""From page rows to product rows, and from collected documents to flat products.

Projections are layered so that each costly intermediate (JSON-LD texts, parsed
nodes, offers) is computed once per page. Nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions import markup, money, text, urls
from vitrine.operators.quality import truthy, truthy_list
from vitrine.workspace import stage

EXTRACTOR_VERSION = "1.0.0"


def parse_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add the parsed parts of each page: product node, breadcrumb node, offers, details."""
    page = F.col(html)
    df = pages.withColumn("_blocks", markup.parsed_blocks(markup.jsonld_texts(page)))
    df = df.withColumns({"_nodes": markup.nodes_of(F.col("_blocks")), "broken_blocks": markup.unparsed(F.col("_blocks"))})
    df = df.withColumns(
        {
            "_product": markup.first_of_type(F.col("_nodes"), "Product"),
            "_crumbs": markup.first_of_type(F.col("_nodes"), "BreadcrumbList"),
        }
    )
    df = df.withColumns(
        {
            "_offers": markup.offers(F.col("_product")),
            "_details": markup.detail_list(page),
            "_description": markup.description(F.col("_product")),
            "_spans": markup.price_spans(page),
            "_title": markup.title(F.col("_product"), page),
        }
    )
    return df.drop("_blocks", "_nodes")


def _chosen(columns: dict[str, Column], fields: Sequence[str] | None) -> Column | None:
    """A struct of the columns that are wanted; none if there are none."""
    kept = [c.alias(name) for name, c in columns.items() if fields is None or name in fields]
    return F.struct(*kept) if kept else None


def extract_products(pages: DataFrame, url: str = "url", html: str = "html", fields: Sequence[str] | None = None) -> DataFrame:
    """One nested product row per page. Pages that cannot be read keep their row, with a status and reason.

    fields: names of the fields in `data` that are wanted, else all. Where two fields of a struct are read, Spark computes the whole
    struct first, so a query that reads a few names them here; what is not named is not there.
    """
    df = parse_pages(pages, url, html)
    product, offers, details = F.col("_product"), F.col("_offers"), F.col("_details")
    desc, spans = F.col("_description"), F.col("_spans")
    raw_condition = F.coalesce(markup.field(product, "itemCondition"), F.try_element_at(details, F.lit("Condition")))
    listed_price = F.coalesce(
        markup.usd_price(offers), F.element_at(spans, F.lit("USD")).cast("double").cast("decimal(18,0)").cast("string")
    )
    reason = F.when(product.isNull() & (F.col("broken_blocks") > 0), F.lit("parse_error")).when(
        F.col("_title").isNull(), F.lit("no_title")
    )
    info = {
        "title": F.col("_title"),
        "product_id": urls.product_id(F.col(url)),
        "description": desc,
        "brand": markup.brand(product),
        "availability": markup.availability(offers),
    }
    specs = {
        "period": F.coalesce(markup.field(product, "productionDate"), F.try_element_at(details, F.lit("Period"))),
        "category": markup.field(product, "category"),
        "condition": markup.condition(raw_condition),
        "condition_raw": raw_condition,
        "dimensions": markup.dimensions(desc),
        "materials": markup.materials(desc),
        "style": markup.style(details, desc),
        "origin": markup.origin(details, desc),
    }
    currencies = markup.multi_currency(offers)
    pricing = {
        "currency": F.when(listed_price.isNotNull(), F.lit("USD")).otherwise(markup.currency(offers)),
        "price": listed_price,
        "multi_currency": F.coalesce(currencies, spans),
    }
    lists = {
        "images": F.coalesce(markup.images(product), F.array().cast("array<string>")),
        "category_breadcrumb": markup.breadcrumb(F.col("_crumbs"), F.col(html)),
    }
    unknown = set(fields or ()) - {name for group in (info, specs, pricing, lists) for name in group}
    if unknown:
        raise ValueError(f"no fields of a product: {sorted(unknown)}")
    groups = {"product_info": _chosen(info, fields), "specifications": _chosen(specs, fields), "pricing": _chosen(pricing, fields)}
    groups |= {name: c for name, c in lists.items() if fields is None or name in fields}
    data = F.struct(*[c.alias(name) for name, c in groups.items() if c is not None])
    kept = [c for c in pages.columns if c not in (url, html)]
    return df.select(
        *kept,
        F.col(url).alias("url"),
        F.when(reason.isNull(), F.lit("success")).otherwise(F.lit("failed")).alias("extraction_status"),
        reason.alias("failure_reason"),
        data.alias("data"),
        F.octet_length(html).alias("html_size_bytes"),
    )


def envelope(products: DataFrame, container: Column, at: Column, duration_ms: Column) -> DataFrame:
    """Wrap extracted products with the metadata of the run."""
    meta = F.struct(
        container.alias("container_id"),
        at.alias("extraction_time"),
        F.col("html_size_bytes"),
        duration_ms.alias("extraction_duration_ms"),
        F.col("data.product_info.product_id").alias("product_id"),
        F.lit(EXTRACTOR_VERSION).alias("extractor_version"),
    )
    return products.select("url", "extraction_status", "data", meta.alias("extraction_metadata"))


def land_products(pages: DataFrame, url: str = "url", html: str = "html", fields: Sequence[str] | None = None) -> DataFrame:
    """Extract once into a Parquet table. Filters and explodes then read the stored fields
    instead of being pushed below the extraction, which would parse every page again.
    What is stored is computed for every page, so name the fields that are read afterwards."""
    return stage(extract_products(pages, url, html, fields), "products")


def flatten_extracted(products: DataFrame) -> DataFrame:
    """The typed nested product as a flat row of the fields that were extracted."""
    fields = products.schema["data"].dataType.fields
    flat = [f"data.{f.name}.*" if isinstance(f.dataType, T.StructType) else f"data.{f.name}" for f in fields]
    return products.select("url", "extraction_status", *flat)


PLACES = {
    "product_id": ["product_id", "product_info.product_id", "data.product_info.product_id"],
    "title": ["title", "product_info.title", "data.product_info.title"],
    "description": ["description", "product_info.description", "data.product_info.description"],
    "category": ["category", "specifications.category", "data.specifications.category"],
    "price": ["price", "pricing.price", "data.pricing.price"],
    "materials": ["materials", "specifications.materials", "data.specifications.materials"],
    "images": ["images", "data.images"],
}
PRODUCT_KEYS = ["product_id", "title", "category", "price", "product_info", "specifications", "pricing", "data"]


def _present(doc: Column, path: str) -> Column:
    """The value at a path as VARIANT: null when the key is absent, VARIANT null when it is null."""
    return F.try_variant_get(doc, f"$.{path}", "variant")


def _found(doc: Column, name: str) -> Column:
    return F.coalesce(*[_present(doc, p) for p in PLACES[name]])


def _as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _price_text(value: Column) -> Column:
    """Price as text; a JSON value that counts as empty (0, false, [], {}) is null."""
    shown = _as_text(value)
    is_text = F.schema_of_variant(value) == "STRING"
    empty = ~is_text & (shown.isin("false", "[]", "{}") | (shown.try_cast("double") == 0))
    return F.when(~F.coalesce(empty, F.lit(False)), shown)


def _text_list(value: Column) -> Column:
    """A list of texts, or one text with commas, as an array."""
    shown = _as_text(value)
    return F.coalesce(
        F.try_variant_get(value, "$", "array<string>"),
        F.when(truthy(shown), F.transform(F.split(shown, ","), text.strip)),
    )


def parse_documents(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse document text and say what each is: product, non_product, non_object or corrupt."""
    df = raw.withColumn("doc", F.try_parse_json(value))
    doc = F.col("doc")
    has_key = F.lit(False)
    for key in PRODUCT_KEYS:
        has_key = has_key | _present(doc, key).isNotNull()
    kind = (
        F.when(doc.isNull(), F.lit("corrupt"))
        .when(~F.startswith(F.schema_of_variant(doc), F.lit("OBJECT")), F.lit("non_object"))
        .when(~has_key, F.lit("non_product"))
        .otherwise(F.lit("product"))
    )
    return df.withColumn("kind", kind)


def flatten_documents(parsed: DataFrame) -> DataFrame:
    """Flat product fields from the top level or either nesting; rows that are no product keep nulls."""
    doc = F.when(F.col("kind") == "product", F.col("doc"))
    df = parsed.withColumns(
        {
            "url": F.try_variant_get(doc, "$.url", "string"),
            "product_id": _as_text(_found(doc, "product_id")),
            "title": _as_text(_found(doc, "title")),
            "description": _as_text(_found(doc, "description")),
            "has_category": _found(doc, "category").isNotNull(),
            "category": _as_text(_found(doc, "category")),
            "price": _price_text(_found(doc, "price")),
            "materials": _text_list(_found(doc, "materials")),
            "images": F.try_variant_get(_found(doc, "images"), "$", "array<string>"),
        }
    ).drop("doc")
    return df.withColumns(
        {
            "amount": money.parse_money(F.col("price")),
            "has_price": truthy(F.col("price")),
            "has_materials": truthy_list(F.col("materials")),
        }
    )


def land_documents(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse and flatten collected documents into a Parquet table, once.

    Every statistic then reads only its own columns of that table. Built on the unlanded
    rows instead, each filter would be pushed below the parsing and parse the text again.
    """
    return stage(flatten_documents(parse_documents(raw, value)).drop(value), "documents")
