"""Page extraction, cleaning and validation."""

import html as stdlib_html
import json

import pytest
from pyspark.sql import functions as F

from vitrine.functions import markup as M
from vitrine.functions import text
from vitrine.operators import extraction, quality

URL = "https://www.market.example/furniture/mirrors/id-f_10001073/"


def product(**extra):
    base = {
        "@context": "http://schema.org", "@type": "Product", "name": "Walnut Mirror",
        "description": "A <i>carved</i> walnut\n frame with brass. Height 34 1/2 x width 48 inches", "brand": {"name": "Atelier"},
        "category": "Wall Mirrors", "productionDate": "18th Century", "itemCondition": "UsedCondition",
        "offers": [{"price": 5400, "priceCurrency": "USD", "availability": "http://schema.org/InStock"},
                   {"price": 4814.55, "priceCurrency": "EUR"}],
        "image": [{"contentUrl": "https://cdn.example/x.jpg?width=1"}, {"contentUrl": "/rel.jpg"}, {"caption": "no url"}],
    }
    return {**base, **extra}


CRUMBS = {"@type": "BreadcrumbList", "itemListElement": [{"position": 2, "name": "Mirrors"}, {"position": 1, "name": "Home"}]}


def page(*blocks, body=""):
    scripts = "".join(
        f'<script data-react-helmet="true" type="application/ld+json">{b if isinstance(b, str) else json.dumps(b)}</script>'
        for b in blocks)
    return f"<html><head><script>var x=1;</script>{scripts}</head><body>{body}</body></html>"


@pytest.fixture(scope="module")
def extract(spark):
    def run(*pages):
        df = spark.createDataFrame([(i, URL, p) for i, p in enumerate(pages)], "i int, url string, html string")
        return [r.asDict(recursive=True) for r in extraction.extract_products(df).orderBy("i").collect()]

    return run


def test_full_page(extract):
    (row,) = extract(page([product(), CRUMBS]))
    data = row["data"]
    assert row["extraction_status"] == "success" and row["failure_reason"] is None
    assert data["product_info"] == {"title": "Walnut Mirror", "product_id": "f_10001073", "brand": "Atelier", "availability": "InStock",
                                    "description": "A carved walnut frame with brass. Height 34 1/2 x width 48 inches"}
    assert data["specifications"]["dimensions"] == {"height": "34 1/2 inches", "width": "48 inches", "depth": None}
    assert data["specifications"]["materials"] == ["Walnut", "Brass"]
    assert (data["specifications"]["condition"], data["specifications"]["period"]) == ("Used", "18th Century")
    assert data["pricing"]["price"] == "5400" and data["pricing"]["currency"] == "USD"
    assert float(data["pricing"]["multi_currency"]["EUR"]) == 4814.55
    assert data["images"] == ["https://cdn.example/x.jpg"]
    assert data["category_breadcrumb"] == ["Home", "Mirrors"]


def test_lone_object_equals_list_of_one(extract):
    lone, listed = extract(page(product()), page([product()]))
    assert lone["data"] == listed["data"]
    lone, listed = extract(page(product(offers={"price": 7, "priceCurrency": "USD"})),
                           page(product(offers=[{"price": 7, "priceCurrency": "USD"}])))
    assert lone["data"]["pricing"] == listed["data"]["pricing"]


def test_price_without_a_usd_offer(extract):
    (row,) = extract(page(product(offers=[{"price": 4831, "priceCurrency": "EUR"}])))
    pricing = row["data"]["pricing"]
    assert (pricing["price"], pricing["currency"]) == (None, "EUR")
    assert {k: float(v) for k, v in pricing["multi_currency"].items()} == {"EUR": 4831.0}


FALLBACK = ('<nav aria-label="breadcrumb"><a href="/">Home</a><a href="/f/"><b>Furniture</b></a></nav>'
            '<h1 class="headline-3">Plain &amp; <b>Simple</b></h1><span data-cy="price-USD">$5,400</span>'
            '<span data-cy="price-EUR">€4,831</span><li>Place of Origin: Italy</li><li>Style: Art Deco</li><li>Style: Modern: late</li>')


def test_no_jsonld_falls_back_to_elements(extract):
    (row,) = extract(page(body=FALLBACK))
    data = row["data"]
    assert row["extraction_status"] == "success"
    assert data["product_info"]["title"] == "Plain & Simple"
    assert data["pricing"]["price"] == "5400"
    assert {k: float(v) for k, v in data["pricing"]["multi_currency"].items()} == {"USD": 5400.0, "EUR": 4831.0}
    assert data["category_breadcrumb"] == ["Home", "Furniture"]
    assert (data["specifications"]["origin"], data["specifications"]["style"]) == ("Italy", "Modern: late")
    assert data["images"] == []


def test_broken_block_keeps_the_row(extract):
    broken, beside = extract(page('{"@type": "Product", '), page('{"bad": ', product()))
    assert (broken["extraction_status"], broken["failure_reason"]) == ("failed", "parse_error")
    assert beside["extraction_status"] == "success" and beside["data"]["product_info"]["title"] == "Walnut Mirror"


def test_no_text_is_cut(extract):
    (row,) = extract(page(product(name="n" * 600, description="d" * 6000 + " oak", image=[
        {"contentUrl": f"https://cdn.example/{i}.jpg"} for i in range(40)])))
    assert len(row["data"]["product_info"]["title"]) == 600
    assert len(row["data"]["product_info"]["description"]) == 6004
    # Materials are looked for in the whole text, and no image is dropped.
    assert row["data"]["specifications"]["materials"] == ["Oak"]
    assert len(row["data"]["images"]) == 40


@pytest.mark.parametrize("change, failures", [
    ({}, []),
    ({"offers": [{"price": 0, "priceCurrency": "USD"}]}, ["price_range"]),
    ({"offers": [{"price": 10_000_000, "priceCurrency": "USD"}]}, ["price_range"]),
    ({"offers": [{"price": 9_999_999, "priceCurrency": "USD"}]}, []),
    ({"image": [{"contentUrl": f"https://cdn.example/{i}.jpg"} for i in range(21)]}, ["too_many_images"]),
    ({"image": [{"contentUrl": f"https://cdn.example/{i}.jpg"} for i in range(20)]}, []),
])
def test_validation(spark, change, failures):
    df = spark.createDataFrame([(URL, page(product(**change)))], "url string, html string")
    d = F.col("data")
    reasons = quality.product_failures(d["product_info"].isNotNull(), d["product_info"]["product_id"], d["images"],
                                       d["pricing"]["multi_currency"], d["pricing"]["price"])
    assert extraction.extract_products(df).select(reasons).first()[0] == failures


@pytest.mark.parametrize("status, kind, size, reason", [
    (200, "text/html", 9_999, "too_small"), (200, "text/html; charset=utf-8", 10_000, None), (200, "text/html", 10_485_760, None),
    (200, "text/html", 10_485_761, "too_large"), (404, "text/html", 20_000, "status"), (200, "image/png", 20_000, "content_type"),
    (None, "text/html", 20_000, "status"), (200, None, 20_000, "content_type")])
def test_content(spark, status, kind, size, reason):
    row = spark.createDataFrame([(status, kind, size)], "s int, k string, n long")
    assert row.select(quality.content_reject_reason(F.col("s"), F.col("k"), F.col("n"))).first()[0] == reason


@pytest.mark.parametrize("raw", [
    "a &amp; b", "&amp;lt;", "&lt;b&gt;", "&#233;&#xE9;", "&#x1F600;", "&eacute;&nbsp;&copy;", "no refs", "&unknownname;", "& alone", "",
    "&amp;&amp;", "tail &quot;"])
def test_unescape_equals_the_standard_rules(spark, raw):
    assert spark.range(1).select(text.unescape_entities(F.lit(raw))).first()[0] == stdlib_html.unescape(raw)


def test_sanitize_walks_every_level(spark):
    dirty = '<script>alert(1)</script> <p onclick="x()">ok &amp; <b>fine</b></p> '
    df = spark.createDataFrame([({"a": dirty, "n": 1, "list": [dirty, None], "m": {"k": dirty}},)],
                               "data struct<a:string,n:int,list:array<string>,m:map<string,string>>")
    row = text.sanitize_strings(df).first().asDict(recursive=True)["data"]
    assert row == {"a": "ok & fine", "n": 1, "list": ["ok & fine", None], "m": {"k": "ok & fine"}}


def test_detail_list_keeps_the_last_value(spark):
    got = spark.range(1).select(M.detail_list(F.lit(FALLBACK))).first()[0]
    assert got == {"Place of Origin": "Italy", "Style": "Modern: late"}


def test_privacy(spark):
    df = spark.createDataFrame([("f_1", "t", "1", "c")], "product_id string, title string, price string, category string")
    assert quality.without_private(df).columns == ["product_id", "category"]


ELEMENTS = "(script|style)"  # in a plan, once for each search for elements of the page


@pytest.mark.parametrize("name, searches", [("spec_dimensions", 0), ("spec_period", 1), ("spec_condition", 1), ("spec_style_origin", 1), ("pricing_usd", 1), ("extract_products", 1)])
def test_queries_compute_only_the_fields_they_read(spark, small, name, searches):
    import __spark_entry__ as entry

    assert entry.queries()[name](spark, small)._jdf.queryExecution().optimizedPlan().toString().count(ELEMENTS) == searches


@pytest.mark.parametrize("name, searches, stored", [
    ("ds_taxonomy", 1, ["product_id", "period", "category", "materials", "style", "images"]), ("ds_image_pairs", 0, ["product_id", "category", "images"])])
def test_what_is_landed_is_read(spark, small, monkeypatch, name, searches, stored):
    import __spark_entry__ as entry

    landed = []
    monkeypatch.setattr(extraction, "stage", lambda df, label: landed.append(df) or df)
    entry.queries()[name](spark, small)
    assert [c for c in extraction.flatten_extracted(landed[0]).columns if c not in ("url", "extraction_status")] == stored
    assert landed[0]._jdf.queryExecution().optimizedPlan().toString().count(ELEMENTS) == searches


def test_wanted_fields_are_as_in_the_whole_product(spark):
    df = spark.createDataFrame([(i, URL, p) for i, p in enumerate([
        page([product(), CRUMBS]), page("{", body="<ul><li>Period: 1960s<li>Style: Art Deco</ul>"), page(), page(product(offers=None, description=None))])], "i int, url string, html string")
    whole = extraction.extract_products(df).orderBy("i")
    data = whole.schema["data"].dataType
    names = [(f"data.{g.name}.{f.name}", f.name) for g in data if hasattr(g.dataType, "fields") for f in g.dataType] + [("data.images", "images"), ("data.category_breadcrumb", "category_breadcrumb")]
    for part in (names[::2], names[1::2]):
        some = extraction.extract_products(df, fields=[name for _, name in part]).orderBy("i")
        read = lambda t: [r.asDict(recursive=True) for r in t.select("i", "url", "extraction_status", "failure_reason", *[F.col(place).alias(name) for place, name in part]).collect()]  # noqa: E731,B023
        assert read(some) == read(whole)
        assert extraction.flatten_extracted(some).columns == ["url", "extraction_status", *[name for _, name in part]]
    assert extraction.flatten_extracted(whole).columns == ["url", "extraction_status", *[name for _, name in names]]
    with pytest.raises(ValueError):
        extraction.extract_products(df, fields=["nothing"])
