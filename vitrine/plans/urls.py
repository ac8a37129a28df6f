"""URL queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import urls as U
from vitrine.plans import inputs as I
from vitrine.plans.registry import query

SQL_PATH = r"regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)"
SQL_SEGMENTS = f"list_filter(string_split({SQL_PATH}, '/'), lambda s: s <> '')"
SQL_TERMS = f"list_filter(regexp_split_to_array({SQL_PATH}, '[/-]'), lambda s: s <> '')"
SQL_SLUG = "seg[len(seg) - 1]"
SQL_YEAR = rf"TRY_CAST(regexp_extract({SQL_SLUG}, '(?:^|-)((?:1[89]|20)\d{{2}})s?(?:-|$)', 1) AS INT)"
SQL_DECADE = f"CASE WHEN {SQL_YEAR} BETWEEN 1800 AND 2029 THEN {SQL_YEAR} // 10 * 10 END"


def features_sql(source: str = I.URLS_SQL) -> str:
    """CTEs that compute the URL features in the check SQL."""
    return f"""WITH src AS ({source}),
 parsed AS (SELECT id, url, {SQL_PATH} AS path, {SQL_SEGMENTS} AS seg, {SQL_TERMS} AS terms FROM src),
 features AS (SELECT *, {SQL_SLUG} AS item_description, len(seg) AS depth_level,
  seg[1:greatest(len(seg) - 2, 0)] AS hierarchy,
  CASE WHEN len(seg) > 2 THEN seg[1] END AS primary_category,
  CASE WHEN len(seg) > 3 THEN seg[2] END AS secondary_category,
  CASE WHEN len(seg) > 4 THEN seg[3] END AS tertiary_category,
  array_to_string(terms, ' ') AS all_terms,
  list_filter(seg, lambda s: contains(s, '-') AND NOT starts_with(s, 'id-f_')) AS hyphenated,
  {SQL_DECADE} AS decade FROM parsed)"""


def _one(column: str, value: str) -> str:
    return f"{features_sql()} SELECT id, {value} AS {column} FROM features"


def _from_url(spark: SparkSession, sf: str, name: str, value: Column) -> DataFrame:
    return I.url_rows(spark, sf).select("id", value.alias(name))


def _joined(value: Column) -> Column:
    return F.array_join(value, "|")


def _segments() -> Column:
    return U.path_segments(F.col("url"))


@query("url_domain", "WITH u AS (" + I.URLS_SQL + r") SELECT id, regexp_extract(url, '^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS domain FROM u")
def url_domain(spark, sf):
    return _from_url(spark, sf, "domain", U.host(F.col("url")))


@query("url_path_segments", _one("segments", "array_to_string(seg, '|')"))
def url_path_segments(spark, sf):
    return _from_url(spark, sf, "segments", _joined(_segments()))


@query("url_depth", _one("depth_level", "depth_level"))
def url_depth(spark, sf):
    return _from_url(spark, sf, "depth_level", U.depth(_segments()))


@query("url_item_id", _one("item_id", r"regexp_extract(url, '/id-f_(\d+)', 1)"))
def url_item_id(spark, sf):
    return _from_url(spark, sf, "item_id", U.item_id(F.col("url")))


@query(
    "url_product_id",
    "WITH u AS (" + I.CANDIDATES_SQL + ") SELECT id, CASE WHEN contains(url, '/id-f_') "
    "THEN 'f_' || split_part(split_part(url, '/id-f_', 2), '/', 1) ELSE substr(md5(url), 1, 10) END AS product_id FROM u",
)
def url_product_id(spark, sf):
    return I.candidates(spark, sf).select("id", U.product_id(F.col("url")).alias("product_id"))


@query("url_item_description", _one("item_description", "item_description"))
def url_item_description(spark, sf):
    return _from_url(spark, sf, "item_description", U.item_description(_segments()))


@query(
    "url_category_hierarchy",
    f"{features_sql()} SELECT id, array_to_string(hierarchy, '|') AS hierarchy, primary_category, secondary_category, "
    "tertiary_category FROM features",
)
def url_category_hierarchy(spark, sf):
    df = I.url_rows(spark, sf).withColumn("seg", _segments())
    levels = [U.category_level(F.col("seg"), i).alias(n) for i, n in
              enumerate(["primary_category", "secondary_category", "tertiary_category"])]
    return df.select("id", _joined(U.category_hierarchy(F.col("seg"))).alias("hierarchy"), *levels)


@query("url_extracted_terms", _one("terms", "array_to_string(terms, '|')"))
def url_extracted_terms(spark, sf):
    return _from_url(spark, sf, "terms", _joined(U.extracted_terms(U.path(F.col("url")))))


@query("url_all_terms", _one("all_terms", "all_terms"))
def url_all_terms(spark, sf):
    return _from_url(spark, sf, "all_terms", U.all_terms(U.path(F.col("url"))))


@query("url_numeric_values", _one("numeric_values", r"array_to_string(regexp_extract_all(path, '\d+'), '|')"))
def url_numeric_values(spark, sf):
    return _from_url(spark, sf, "numeric_values", _joined(U.numeric_values(U.path(F.col("url")))))


@query("url_hyphenated_terms", _one("hyphenated_terms", "array_to_string(hyphenated, '|')"))
def url_hyphenated_terms(spark, sf):
    return _from_url(spark, sf, "hyphenated_terms", _joined(U.hyphenated_terms(U.path(F.col("url")))))


@query(
    "url_capitalized_terms",
    _one("capitalized_terms", r"array_to_string(list_filter(terms, lambda t: regexp_matches(t, '^\p{Lu}')), '|')"),
)
def url_capitalized_terms(spark, sf):
    return _from_url(
        spark, sf, "capitalized_terms", _joined(U.capitalized_terms(U.path(F.col("url"))))
    )


@query("url_decade", _one("decade", "decade"))
def url_decade(spark, sf):
    return _from_url(spark, sf, "decade", U.decade(U.item_description(_segments())))


@query(
    "url_keyword_category",
    "WITH u AS (" + I.URLS_SQL + """) SELECT id,
 CASE WHEN contains(url, 'seating') THEN 'Seating' WHEN contains(url, 'tables') THEN 'Tables'
  WHEN contains(url, 'lighting') THEN 'Lighting' ELSE 'Storage' END AS category,
 CASE WHEN contains(url, 'seating') THEN CASE WHEN contains(url, 'chairs') THEN 'Chairs' ELSE 'Benches' END
  WHEN contains(url, 'tables') THEN 'Dining Tables' WHEN contains(url, 'lighting') THEN 'Floor Lamps'
  ELSE 'Cabinets' END AS subcategory,
 CASE WHEN contains(url, 'modern') THEN 'Wood, Metal' ELSE 'Fabric, Wood' END AS materials FROM u""",
)
def url_keyword_category(spark, sf):
    u = F.col("url")
    df = I.url_rows(spark, sf).select(
        "id", U.keyword_category(u).alias("k"), F.array_join(U.keyword_materials(u), ", ").alias("materials")
    )
    return df.select("id", "k.category", "k.subcategory", "materials")


FEATURE_COLUMNS = (
    "id, url, regexp_extract(url, '^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS domain, depth_level, item_description, "
    "all_terms, primary_category, secondary_category, tertiary_category, decade, array_to_string(hyphenated, '|') AS hyphenated_terms"
)


def _features(rows: DataFrame) -> DataFrame:
    return U.with_url_features(rows).select(
        "id", "url", "domain", "depth_level", "item_description", "all_terms", "primary_category",
        "secondary_category", "tertiary_category", "decade", _joined(F.col("hyphenated_terms")).alias("hyphenated_terms"),
    )


@query("url_features", f"{features_sql()} SELECT {FEATURE_COLUMNS} FROM features")
def url_features(spark, sf):
    return _features(I.url_rows(spark, sf))


@query("url_features_volume", f"{features_sql(I.LINES_SQL)} SELECT {FEATURE_COLUMNS} FROM features")
def url_features_volume(spark, sf):
    return _features(I.line_urls(spark, sf))
