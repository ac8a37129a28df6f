"""Column builders over listing URLs.

Everything is a native expression on the URL text that stays inside whole-stage code
generation; higher-order functions, which do not, are avoided. The path and host patterns
follow the generic URI grammar, so a malformed URL still yields what can be read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATH = r"^[^:/?#]+://[^/?#]*([^?#]*)"
HOST = r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)"
YEAR_IN_SLUG = r"(?:^|-)((?:1[89]|20)\d{2})s?(?:-|$)"

# The keyword rules, first match wins.
KEYWORD_RULES = [
    # substring, category, (substring, subcategory) refinement, subcategory otherwise
    ("seating", "Seating", ("chairs", "Chairs"), "Benches"),
    ("tables", "Tables", None, "Dining Tables"),
    ("lighting", "Lighting", None, "Floor Lamps"),
]
KEYWORD_DEFAULT = ("Storage", "Cabinets")


def host(url: Column, drop_www: bool = False) -> Column:
    h = F.regexp_extract(url, HOST, 1)
    return F.regexp_replace(h, r"^www\.", "") if drop_www else h


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def path_segments(url: Column) -> Column:
    return F.array_remove(F.split(path(url), "/"), "")


def depth(segments: Column) -> Column:
    return F.size(segments)


def item_id(url: Column) -> Column:
    return F.regexp_extract(url, r"/id-f_(\d+)", 1)


def product_id(url: Column, hash_len: int = 10) -> Column:
    """Text between the first '/id-f_' and the next '/', or an md5 prefix when there is no id."""
    after = F.substring_index(F.split_part(url, F.lit("/id-f_"), F.lit(2)), "/", 1)
    return F.when(F.contains(url, F.lit("/id-f_")), F.concat(F.lit("f_"), after)).otherwise(
        F.substring(F.md5(url), 1, hash_len)
    )


def item_description(segments: Column) -> Column:
    return F.try_element_at(segments, F.lit(-2))


def category_hierarchy(segments: Column) -> Column:
    return F.slice(segments, F.lit(1), F.greatest(F.size(segments) - 2, F.lit(0)))


def category_level(segments: Column, level: int) -> Column:
    """Level 0 is the primary category, 1 the secondary, 2 the tertiary."""
    return F.when(F.size(segments) - 2 > level, F.get(segments, F.lit(level)))


def extracted_terms(url_path: Column) -> Column:
    return F.array_remove(F.split(url_path, "[/-]"), "")


def all_terms(url_path: Column) -> Column:
    """The terms joined by blanks, straight from the path text."""
    return F.btrim(F.regexp_replace(url_path, "[/-]+", " "))


def numeric_values(url_path: Column) -> Column:
    return F.regexp_extract_all(url_path, F.lit(r"\d+"), F.lit(0))


def hyphenated_terms(url_path: Column) -> Column:
    """Segments that hold a hyphen, the id segment left out."""
    return F.regexp_extract_all(url_path, F.lit(r"(?<=/)(?!id-f_)[^/]*-[^/]*"), F.lit(0))


def capitalized_terms(url_path: Column) -> Column:
    return F.regexp_extract_all(url_path, F.lit(r"(?<=[/-])\p{Lu}[^/-]*"), F.lit(0))


def decade(slug: Column, min_year: int = 1800, max_year: int = 2029) -> Column:
    """Decade of the first year written in the slug; null without one or out of range.

    The decades of all years in range are a constant array indexed by the year: the year
    occurs once in the expression, so a filter on the decade does not repeat the parsing.
    """
    year = F.regexp_extract(slug, YEAR_IN_SLUG, 1).try_cast("int")
    # One literal, folded to an array when the query is planned.
    decades = F.from_json(F.lit(json.dumps([y // 10 * 10 for y in range(min_year, max_year + 1)])), "array<int>")
    return F.get(decades, year - min_year)


def keyword_category(url: Column) -> Column:
    chosen = None
    for word, category, refine, default in KEYWORD_RULES:
        sub = F.lit(default)
        if refine:
            sub = F.when(F.contains(url, F.lit(refine[0])), F.lit(refine[1])).otherwise(sub)
        pair = F.struct(F.lit(category).alias("category"), sub.alias("subcategory"))
        hit = F.contains(url, F.lit(word))
        chosen = F.when(hit, pair) if chosen is None else chosen.when(hit, pair)
    return chosen.otherwise(
        F.struct(F.lit(KEYWORD_DEFAULT[0]).alias("category"), F.lit(KEYWORD_DEFAULT[1]).alias("subcategory"))
    )


def keyword_materials(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("modern")), F.array(F.lit("Wood"), F.lit("Metal"))).otherwise(
        F.array(F.lit("Fabric"), F.lit("Wood"))
    )


def with_url_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Add the URL metadata record. Path and segments are projected once and shared by the rest."""
    u = F.col(url)
    df = df.withColumn("path", path(u))
    df = df.withColumn("path_segments", F.array_remove(F.split("path", "/"), ""))
    seg = F.col("path_segments")
    df = df.withColumn("item_description", item_description(seg))
    return df.withColumns(
        {
            "domain": host(u),
            "depth_level": depth(seg),
            "item_id": item_id(u),
            "product_id": product_id(u),
            "category_hierarchy": category_hierarchy(seg),
            "primary_category": category_level(seg, 0),
            "secondary_category": category_level(seg, 1),
            "tertiary_category": category_level(seg, 2),
            "extracted_terms": extracted_terms(F.col("path")),
            "all_terms": all_terms(F.col("path")),
            "numeric_values": numeric_values(F.col("path")),
            "hyphenated_terms": hyphenated_terms(F.col("path")),
            "capitalized_terms": capitalized_terms(F.col("path")),
            "decade": decade(F.col("item_description")),
        }
    )
