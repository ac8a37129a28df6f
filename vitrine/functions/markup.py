"""Reading listing pages: embedded JSON-LD and the few HTML elements used as a fallback.

JSON is parsed to VARIANT first, because a lone object and a list of objects are
both legal wherever a list is expected, and a fixed schema would null out one of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions import elements, money, text

# Tags and attributes as a parser takes them: any letter case, blanks around '=', either quote or none.
JSONLD_SCRIPT = r"(?is)<script\s[^>]*?\btype\s*=\s*[\"']?\s*application/ld\+json\b[^>]*>(.*?)</script\s*>"
HEADLINE = (
    r"(?is)<h1\s[^>]*?\bclass\s*=\s*"
    r"(?:\"[^\"]*headline-3[^\"]*\"|'[^']*headline-3[^']*'|[^\s\"'>]*headline-3[^\s\"'>]*)[^>]*>(.*?)</h1\s*>"
)
PRICE_MARK = r"(?i)^price-([a-z]{3})$"
BREADCRUMB_NAV = r"(?is)<nav\s[^>]*?\baria-label\s*=\s*[\"']?\s*breadcrumb\b[^>]*>(.*?)</nav\s*>"
ANCHOR_TEXT = r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>"
# Possessive groups: a long run of digits and blanks is read once and never tried again.
DIMENSIONS = (
    r"Height([\d\s/]++)x\s*+width([\d\s/]++)(?:x\s*+depth([\d\s/]++))?(?:(inches|inch|in|cm|mm|feet|ft)\b)?"
)
PERIOD_FORMAT = r"^(?:\d{1,2}(?:st|nd|rd|th) Century|\d{4}s|\d{4}-\d{4}|Contemporary)$"

# Material keywords, style and origin names.
MATERIALS = ["walnut", "oak", "brass", "marble", "glass", "ceramic"]
STYLES = ["Mid-Century Modern", "Art Deco", "Contemporary"]
ORIGINS = ["Italy", "France", "United States"]


def jsonld_texts(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(JSONLD_SCRIPT), F.lit(1))


def as_variant_list(value: Column) -> Column:
    """A VARIANT list as an array; a lone value as an array of one; null as null."""
    return F.coalesce(
        F.try_variant_get(value, "$", "array<variant>"), F.when(value.isNotNull(), F.array(value))
    )


def parsed_blocks(texts: Column) -> Column:
    """Every block as VARIANT, null if it is not JSON."""
    return F.transform(texts, F.try_parse_json)


def nodes_of(blocks: Column) -> Column:
    """All objects of all blocks that parse, in page order."""
    return F.flatten(F.transform(F.filter(blocks, lambda v: v.isNotNull()), as_variant_list))


def unparsed(blocks: Column) -> Column:
    """Number of blocks that are not JSON."""
    return F.size(F.filter(blocks, lambda v: v.isNull()))


def jsonld_nodes(texts: Column) -> Column:
    return nodes_of(parsed_blocks(texts))


def broken_blocks(texts: Column) -> Column:
    return unparsed(parsed_blocks(texts))


def node_type(node: Column) -> Column:
    return F.try_variant_get(node, "$['@type']", "string")


def first_of_type(nodes: Column, name: str) -> Column:
    return F.get(F.filter(nodes, lambda n: node_type(n) == name), F.lit(0))


def field(node: Column, path: str) -> Column:
    return F.try_variant_get(node, f"$.{path}", "string")


def headline(html: Column) -> Column:
    return F.nullif(text.visible_text(F.regexp_extract(html, HEADLINE, 1)), F.lit(""))


def title(product: Column, html: Column) -> Column:
    return F.coalesce(F.nullif(field(product, "name"), F.lit("")), headline(html))


def description(product: Column) -> Column:
    return text.visible_text(field(product, "description"))


def brand(product: Column) -> Column:
    return field(product, "brand.name")


def offers(product: Column) -> Column:
    raw = as_variant_list(F.try_variant_get(product, "$.offers", "variant"))
    return F.transform(
        raw,
        lambda o: F.struct(
            field(o, "priceCurrency").alias("currency"),
            field(o, "price").alias("price"),
            F.coalesce(
                F.try_variant_get(o, "$.price", "decimal(18,2)"),
                money.parse_money(field(o, "price")).try_cast("decimal(18,2)"),
            ).alias("amount"),
            field(o, "availability").alias("availability"),
        ),
    )


def availability(offer_list: Column) -> Column:
    return F.regexp_replace(F.get(offer_list, F.lit(0))["availability"], r"^https?://schema\.org/", "")


def condition(raw: Column) -> Column:
    return F.regexp_replace(raw, "Condition$", "")


def is_period(value: Column) -> Column:
    return value.rlike(PERIOD_FORMAT)


def _last_per_key(entries: Column) -> Column:
    """Entries whose key does not come again later, so that building a map cannot fail.

    They are sorted by key and place, and the last of each run of one key is kept. The list is bound to a
    lambda variable first; written into the inner function as it is, its expression would be evaluated again.
    """

    def last_of_runs(es: Column) -> Column:
        following = F.slice(es, F.lit(2), F.greatest(F.size(es), F.lit(1)))
        kept = F.zip_with(es, following, lambda e, n: F.when(n["key"].isNull() | (n["key"] != e["key"]), F.struct(e["key"].alias("key"), e["value"].alias("value"))))
        return F.filter(kept, lambda e: e.isNotNull())

    placed = F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"), e["value"].alias("value")))
    return F.get(F.transform(F.array(F.sort_array(placed)), last_of_runs), F.lit(0))


def multi_currency(offer_list: Column) -> Column:
    priced = F.filter(offer_list, lambda o: o["currency"].isNotNull() & o["amount"].isNotNull())
    entries = F.transform(priced, lambda o: F.struct(o["currency"].alias("key"), o["amount"].alias("value")))
    return F.map_from_entries(_last_per_key(entries))


def usd_price(offer_list: Column) -> Column:
    """Price text of the USD offer; an offer without a currency counts as USD."""
    in_usd = F.filter(offer_list, lambda o: F.coalesce(o["currency"], F.lit("USD")) == "USD")
    return F.get(in_usd, F.lit(0))["price"]


def currency(offer_list: Column, default: str = "USD") -> Column:
    """USD when there is a USD price, else the currency of the first offer."""
    first = F.get(offer_list, F.lit(0))["currency"]
    return F.when(usd_price(offer_list).isNotNull(), F.lit("USD")).otherwise(F.coalesce(first, F.lit(default)))


def price_spans(html: Column) -> Column:
    """Displayed prices by currency, whatever markup stands inside the span."""
    marked = F.transform(
        elements.spans(html),
        lambda s: F.struct(F.upper(F.regexp_extract(text.strip(elements.attribute(s["open"], "data-cy")), PRICE_MARK, 1)).alias("key"), s.alias("span")),
    )
    priced = F.filter(marked, lambda m: m["key"] != "")
    entries = F.transform(priced, lambda m: F.struct(m["key"].alias("key"), money.amount_in_text(elements.shown(m["span"])).alias("value")))
    return F.map_from_entries(_last_per_key(F.filter(entries, lambda e: e["value"].isNotNull())))


def detail_list(html: Column) -> Column:
    """List items of the form 'Key: Value' as a map, whatever markup stands inside; the last value of a key stays."""
    entries = F.transform(
        F.filter(elements.list_items(html), lambda i: F.contains(i, F.lit(":"))),
        lambda i: F.struct(
            text.strip(F.substring_index(i, ":", 1)).alias("key"),
            text.strip(F.regexp_replace(i, "^[^:]*:", "")).alias("value"),
        ),
    )
    return F.map_from_entries(_last_per_key(F.filter(entries, lambda e: (e["key"] != "") & (e["value"] != ""))))


def images(product: Column) -> Column:
    """Absolute image URLs without their query part, however many there are."""
    raw = as_variant_list(F.try_variant_get(product, "$.image", "variant"))
    # an image is an object with its URL, or the URL itself
    named = lambda i: F.coalesce(field(i, "contentUrl"), field(i, "url"), F.try_variant_get(i, "$", "string"))
    urls = F.transform(raw, lambda i: F.split_part(named(i), F.lit("?"), F.lit(1)))
    return F.filter(urls, lambda u: u.rlike("^https?://"))


def breadcrumb(crumbs: Column, html: Column) -> Column:
    """Names of the BreadcrumbList by position, else the anchors of the breadcrumb navigation."""
    items = as_variant_list(F.try_variant_get(crumbs, "$.itemListElement", "variant"))
    placed = F.array_sort(
        F.transform(
            items,
            lambda i: F.struct(
                F.try_variant_get(i, "$.position", "int").alias("position"),
                F.coalesce(field(i, "name"), field(i, "item.name")).alias("name"),
            ),
        )
    )
    nav = F.regexp_extract(html, BREADCRUMB_NAV, 1)
    anchors = F.transform(F.regexp_extract_all(nav, F.lit(ANCHOR_TEXT), F.lit(1)), text.visible_text)
    return F.coalesce(F.transform(placed, lambda p: p["name"]), anchors)


def dimensions(description_text: Column, default_unit: str = "inches") -> Column:
    """Height, width and optional depth, each with its unit; null when the pattern is absent."""
    unit = F.coalesce(F.nullif(F.regexp_extract(description_text, DIMENSIONS, 4), F.lit("")), F.lit(default_unit))

    def measure(group: int) -> Column:
        found = F.btrim(F.regexp_extract(description_text, DIMENSIONS, group))
        return F.when(found != "", F.concat_ws(" ", found, unit))

    whole = F.struct(measure(1).alias("height"), measure(2).alias("width"), measure(3).alias("depth"))
    return F.when(description_text.rlike(DIMENSIONS), whole)


def materials(description_text: Column, keywords: list[str] | None = None) -> Column:
    """Material keywords found as whole words, capitalised, in keyword order. One pass over the text for all of them."""
    words = keywords or MATERIALS
    if not all(w.isalnum() and w == w.lower() for w in words):
        raise ValueError("material keywords are single lower-case words")
    pattern = rf"(?U)\b({'|'.join(words)})\b"
    found = F.regexp_extract_all(F.lower(description_text), F.lit(pattern), F.lit(1))
    hits = F.transform(F.array_intersect(F.array(*[F.lit(w) for w in words]), found), F.initcap)
    return F.coalesce(hits, F.array().cast("array<string>"))


def first_mentioned(value: Column, names: list[str]) -> Column:
    """The first of `names` that occurs in the text."""
    return F.coalesce(*[F.when(F.contains(value, F.lit(name)), F.lit(name)) for name in names])


def style(details: Column, description_text: Column) -> Column:
    return F.coalesce(F.try_element_at(details, F.lit("Style")), first_mentioned(description_text, STYLES))


def origin(details: Column, description_text: Column) -> Column:
    return F.coalesce(F.try_element_at(details, F.lit("Place of Origin")), first_mentioned(description_text, ORIGINS))
