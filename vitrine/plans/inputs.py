"""Listings, pages, documents and run rows derived from the given tables.

The given tables hold no listing URLs or product pages, so they are composed from
`part`, one per row; runs come from `events`, raw markup from `pages`. The derivations
that both Spark and the check SQL need are written once, in SQL both understand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.sources.tables import read_parquet
from vitrine.workspace import partitions_for

HOST = "www.market.example"

SECONDARY = """CASE p_type WHEN 'ECONOMY' THEN 'seating' WHEN 'STANDARD' THEN 'tables' WHEN 'MEDIUM' THEN 'lighting'
 WHEN 'LARGE' THEN 'storage-case-pieces' WHEN 'PROMO' THEN 'mirrors' ELSE 'decorative-objects' END"""

LISTING_URL = f"""concat('https://{HOST}/furniture/', {SECONDARY}, '/',
 CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_type = 'ECONOMY' AND p_partkey % 3 = 1 THEN 'chairs/'
  ELSE concat(replace(p_brand, '#', '-'), '/') END,
 replace(p_name, ' ', '-'),
 CASE WHEN p_partkey % 5 = 0 THEN '-modern' ELSE '' END,
 CASE WHEN p_partkey % 4 = 0 THEN concat('-', CAST(1880 + p_partkey % 140 AS STRING), 's') ELSE '' END,
 '/id-f_', CAST(p_partkey AS STRING), '/')"""

# Every ninth listing is left as it is; the others break one rule each.
CANDIDATE_URL = f"""CASE p_partkey % 9
 WHEN 0 THEN {LISTING_URL}
 WHEN 1 THEN concat('http://{HOST}/x/id-f_', CAST(p_partkey AS STRING), '/')
 WHEN 2 THEN concat('https://other.example/x/id-f_', CAST(p_partkey AS STRING), '/')
 WHEN 3 THEN concat('https://{HOST}/x/../id-f_', CAST(p_partkey AS STRING), '/')
 WHEN 4 THEN concat('https://{HOST}/x//id-f_', CAST(p_partkey AS STRING), '/')
 WHEN 5 THEN concat('https://{HOST}/a/', CAST(p_partkey AS STRING), '/')
 WHEN 6 THEN concat('https://{HOST}/x/id-f_', CAST(p_partkey AS STRING), '?p=1')
 WHEN 7 THEN concat('https://{HOST}/x/id-f_ab', CAST(p_partkey AS STRING), '/')
 ELSE concat('https://{HOST}/id-f_', CAST(p_partkey AS STRING), '/') END"""

# One URL per order line, for volume.
LINE_URL = f"""concat('https://{HOST}/furniture/',
 CASE l_returnflag WHEN 'A' THEN 'seating/chairs' WHEN 'N' THEN 'tables/coffee-tables' ELSE 'lighting' END,
 '/maker-', CAST(l_suppkey AS STRING), '-piece-', CAST(l_partkey AS STRING), '-',
 CAST(1900 + l_linenumber * 10 AS STRING), 's/id-f_', CAST(l_orderkey * 10 + l_linenumber AS STRING), '/')"""
LINES_SQL = f"SELECT l_orderkey AS id, {LINE_URL} AS url FROM lineitem"

LISTINGS_SQL = f"SELECT p_partkey AS id, {LISTING_URL} AS url FROM part"
URLS_SQL = f"""{LISTINGS_SQL} UNION ALL SELECT 1000000000 + page_id AS id, url FROM pages"""
CANDIDATES_SQL = f"""SELECT p_partkey AS id, {CANDIDATE_URL} AS url FROM part
 UNION ALL SELECT 1000000000 + page_id AS id, url FROM pages"""

# A displayed price: mostly '$1,234.50', some of the forms that are no price.
PRICE_TEXT_CASES = """CASE CAST({key} % 17 AS INT) WHEN 3 THEN NULL WHEN 5 THEN '' WHEN 7 THEN 'Price on request'
 WHEN 9 THEN '1.0d' WHEN 11 THEN '0' WHEN 13 THEN '1_000' WHEN 15 THEN 'nan' ELSE {shown} END"""

# A run over the events table: one event is one processed item.
RUN_SQL = """SELECT event_id, ts, user_id, concat('unit', CAST(user_id % 8 AS STRING)) AS container,
 concat('region', CAST(user_id % 3 AS STRING)) AS region,
 event_type <> 'error' AS ok,
 CASE WHEN event_type <> 'error' THEN NULL WHEN user_id % 3 = 0 THEN 'not_found' WHEN user_id % 3 = 1 THEN 'timeout'
  ELSE 'parse_error' END AS error_type,
 value AS duration, value * 10 AS fetch_ms, value * 2 AS extract_ms,
 1000 + event_id % 5000 AS bytes, 1000 + event_id % 5000 AS downloaded, 200 + event_id % 900 AS saved
 FROM events"""


def _from_part(spark: SparkSession, sf: str, url: str) -> DataFrame:
    part = read_parquet(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return part.select(F.col("p_partkey").alias("id"), F.expr(url).alias("url"))


def _page_urls(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, sf, "pages").select((F.col("page_id") + 1000000000).alias("id"), "url")


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return _from_part(spark, sf, LISTING_URL)


def line_urls(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_parquet(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return lines.select(F.col("l_orderkey").alias("id"), F.expr(LINE_URL).alias("url"))


def url_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Listing URLs and the raw page URLs."""
    return listings(spark, sf).unionByName(_page_urls(spark, sf))


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _from_part(spark, sf, CANDIDATE_URL).unionByName(_page_urls(spark, sf))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, sf, "events").selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "user_id",
        "concat('unit', CAST(user_id % 8 AS STRING)) AS container",
        "concat('region', CAST(user_id % 3 AS STRING)) AS region",
        "event_type <> 'error' AS ok",
        "CASE WHEN event_type <> 'error' THEN NULL WHEN user_id % 3 = 0 THEN 'not_found' "
        "WHEN user_id % 3 = 1 THEN 'timeout' ELSE 'parse_error' END AS error_type",
        "value AS duration",
        "value * 10 AS fetch_ms",
        "value * 2 AS extract_ms",
        "1000 + event_id % 5000 AS bytes",
        "1000 + event_id % 5000 AS downloaded",
        "200 + event_id % 900 AS saved",
    )


# --- product pages -------------------------------------------------------------------------------
# Page forms, by p_partkey % 10:
#  0 a list with Product and BreadcrumbList     5 Product without offers, prices only in spans
#  1 a lone Product object, navigation anchors  6 offers and image as lone objects
#  2 two script blocks                          7 21 images
#  3 a block that is cut off                    8 price 0
#  4 no JSON-LD                                 9 no name, no description

DESCRIPTION_TEXT = """concat('An <b>elegant</b> ', p_name, ' in walnut &amp; ', CASE WHEN p_partkey % 2 = 0 THEN 'Brass' ELSE 'glass' END,
 '.  Height ', CAST(p_size AS STRING), ' 1/2 x width ', CAST(p_size + 10 AS STRING), ' inches. Art Deco, made in Italy.')"""

_PRODUCT = f"""concat('{{"@context":"http://schema.org","@type":"Product"',
 CASE WHEN p_partkey % 10 = 9 THEN '' ELSE concat(',"name":"', p_name, ' ', p_brand, '","description":"', {DESCRIPTION_TEXT}, '"') END,
 ',"brand":{{"name":"', p_brand, '"}},"category":"', p_type, '","productionDate":"', CAST(1900 + p_partkey % 10 * 10 AS STRING), 's"',
 ',"itemCondition":"UsedCondition"',
 CASE p_partkey % 10
  WHEN 5 THEN ''
  WHEN 6 THEN concat(',"offers":{{"price":', CAST(p_partkey + 100 AS STRING), ',"priceCurrency":"USD","availability":"http://schema.org/InStock"}}')
  WHEN 8 THEN ',"offers":[{{"price":0,"priceCurrency":"USD","availability":"https://schema.org/OutOfStock"}}]'
  ELSE concat(',"offers":[{{"price":', CAST(p_partkey + 100 AS STRING), ',"priceCurrency":"USD","availability":"http://schema.org/InStock"}},',
   '{{"price":', CAST(p_partkey + 90 AS STRING), '.25,"priceCurrency":"EUR","availability":"http://schema.org/InStock"}}]') END,
 ',"image":',
 CASE WHEN p_partkey % 10 = 6 THEN concat('{{"contentUrl":"https://cdn.market.example/', CAST(p_partkey AS STRING), '_1.jpg?width=768"}}')
  ELSE concat('[', array_join(transform(sequence(1, CASE WHEN p_partkey % 10 = 7 THEN 21 ELSE 1 + CAST(p_partkey % 4 AS INT) END),
   i -> concat('{{"contentUrl":"https://cdn.market.example/', CAST(p_partkey AS STRING), '_', CAST(i AS STRING), '.jpg?width=768"}}')), ','),
   ',{{"contentUrl":"/relative.jpg"}},{{"caption":"none"}}]') END,
 '}}')"""

_CRUMBS = """concat('{"@type":"BreadcrumbList","itemListElement":[{"position":2,"name":"', p_type, '"},{"position":1,"name":"Home"}]}')"""


def _script(body: str) -> str:
    return f"""concat('<script data-react-helmet="true" type="application/ld+json">', {body}, '</script>')"""


PAGE_HTML = f"""concat('<!DOCTYPE html><html><head><script>var a = "x";</script>',
 CASE p_partkey % 10
  WHEN 1 THEN {_script(_PRODUCT)}
  WHEN 2 THEN concat({_script(_CRUMBS)}, {_script(_PRODUCT)})
  WHEN 3 THEN {_script(f"left({_PRODUCT}, 60)")}
  WHEN 4 THEN ''
  ELSE {_script(f"concat('[', {_PRODUCT}, ',', {_CRUMBS}, ']')")} END,
 '</head><body><nav aria-label="breadcrumb"><a href="/">Home</a> <a href="/f/">Furniture</a></nav>',
 '<h1 class="headline-3">', p_name, ' &amp; ', p_brand, '</h1>',
 CASE p_partkey % 4
  WHEN 0 THEN concat('<span data-cy="price-USD">$', CAST(1000 + p_partkey % 9 AS STRING), '</span><span data-cy="price-EUR">€', CAST(900 + p_partkey % 9 AS STRING), '</span>')
  WHEN 1 THEN concat('<span class="prices"><SPAN data-cy=price-USD title="a > b"><span class="sign">$</span>', CAST(1000 + p_partkey % 9 AS STRING),
   '</SPAN> or <span data-cy="price-EUR"><b>', CAST(900 + p_partkey % 9 AS STRING), '</b> €</span></span>')
  ELSE concat('<!-- <span data-cy="price-USD">$1</span> --><span data-cy=\\'price-EUR\\'><i>€</i> ', CAST(900 + p_partkey % 9 AS STRING),
   '</span><p><span data-cy="price-USD">US$ <s></s>', CAST(1000 + p_partkey % 9 AS STRING), '</p>') END,
 CASE p_partkey % 3
  WHEN 0 THEN '<div class="product-details"><li>Condition: Good</li><li>Period: Unknown</li><li>Place of Origin: France</li><li>Period: 1960s</li></div>'
  WHEN 1 THEN concat('<ul class="product-details"><li><b>Place of Origin</b>: <a href="/fr">France</a></li><li>Materials:<ul><li>Walnut<li>Brass: polished</ul></li>',
   '<li><span>Period</span><span>:</span> <em>1960s</em></li><LI class="x > y"><strong>Condition:</strong> Good</LI></ul>')
  ELSE '<ul><li>Condition: Good<li>Place of Origin:<div>France</div><li><!-- <li>Period: 1700s</li> -->Period: <script>"<li>Period: no</li>"</script>1960s</ul>' END,
 '</body></html>')"""


# A row of `part` takes a few bytes of a file that is read as one split, and becomes a page that takes milliseconds to read.
PART_BYTES = 128 << 10


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per part, made in tasks of about `PART_BYTES` of the table."""
    part = read_parquet(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    spread = part.repartition(partitions_for(part, PART_BYTES), "p_partkey")
    return spread.select(F.col("p_partkey").alias("id"), F.expr(LISTING_URL).alias("url"), F.expr(PAGE_HTML).alias("html"))


# --- collected documents -------------------------------------------------------------------------
# Document forms, by p_partkey % 9:
#  0 flat, price as text          3 one-level nested, no pricing   6 flat, category null, number price
#  1 nested under `data`          4 JSON array                     7 flat, 'Price on request', no materials
#  2 flat, price null             5 cut off                        8 a summary, no product keys

DOCUMENT_TEXT = """CASE p_partkey % 9
 WHEN 0 THEN concat('{"product_id":"f_', p_partkey, '","title":"', p_name, '","category":"', p_type, '","price":"$', format_number(p_retailprice, 2), '","materials":["Wood","Metal"]}')
 WHEN 1 THEN concat('{"url":"u', p_partkey, '","data":{"product_info":{"title":"', p_name, '","product_id":"f_', p_partkey, '"},"specifications":{"category":"', p_type, '","materials":"Walnut, Brass"},"pricing":{"price":"', p_partkey * 3, '"}}}')
 WHEN 2 THEN concat('{"product_id":"f_', p_partkey, '","title":"', p_name, '","category":"', p_type, '","price":null,"materials":[]}')
 WHEN 3 THEN concat('{"product_info":{"title":"', p_name, '","product_id":"f_', p_partkey, '"},"specifications":{"category":"', p_type, '","materials":"Oak"}}')
 WHEN 4 THEN concat('[{"product_id":"f_', p_partkey, '"},{"price":"1"}]')
 WHEN 5 THEN concat('{"product_id":"f_', p_partkey, '","broken": ')
 WHEN 6 THEN concat('{"product_id":"f_', p_partkey, '","title":"', p_name, '","category":null,"price":', p_partkey * 10, '}')
 WHEN 7 THEN concat('{"product_id":"f_', p_partkey, '","title":"', p_name, '","category":"', p_type, '","price":"Price on request"}')
 ELSE concat('{"total_processed":', p_partkey, ',"products":[]}') END"""

# What the documents above hold, as the check SQL sees it.
DOCUMENTS_SQL = """SELECT p_partkey AS id, concat('f_', p_partkey) AS product_id, p_partkey % 2 + 1 AS instance, p_partkey % 5 + 1 AS chunk,
 CASE p_partkey % 9 WHEN 4 THEN 'non_object' WHEN 5 THEN 'corrupt' WHEN 8 THEN 'non_product' ELSE 'product' END AS kind,
 CASE WHEN p_partkey % 9 IN (0,1,2,3,7) THEN p_type END AS category,
 p_partkey % 9 IN (0,1,2,3,6,7) AS has_category,
 p_partkey % 9 IN (0,1,7) OR (p_partkey % 9 = 6 AND p_partkey > 0) AS has_price,
 p_partkey % 9 IN (0,1,3) AS has_materials,
 CASE WHEN p_partkey % 9 = 0 THEN round(p_retailprice, 2) WHEN p_partkey % 9 = 1 THEN p_partkey * 3.0
  WHEN p_partkey % 9 = 6 AND p_partkey > 0 THEN p_partkey * 10.0 END AS amount FROM part"""


def document_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Document text with the directory names it is stored under."""
    return read_parquet(spark, sf, "part").select(
        F.expr(DOCUMENT_TEXT).alias("value"),
        (F.col("p_partkey") % 2 + 1).alias("instance_"),
        (F.col("p_partkey") % 5 + 1).alias("chunk_"),
    )
