"""Joins between stored tables. All are equi joins on a URL, a product id or a chunk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_url(left: DataFrame, right: DataFrame, how: str = "inner", url: str = "url") -> DataFrame:
    """Combine two URL-keyed tables; columns both have are kept from the left."""
    shared = [c for c in right.columns if c in left.columns and c != url]
    return left.join(right.drop(*shared), url, how)


def pending(urls: DataFrame, results: DataFrame, key: str = "url") -> DataFrame:
    """URLs without a result. Results collapse to their distinct keys first: a URL with many
    results then costs one row, and the join reuses that shuffle."""
    return urls.join(results.select(key).distinct(), key, "left_anti")


def completed(rows: DataFrame, summaries: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows of chunks that have a summary."""
    return rows.join(summaries.select(key).distinct(), key, "left_semi")


def match_files(html: DataFrame, documents: DataFrame, key: str = "product_id") -> DataFrame:
    """Which ids have a page, a document, or both. Each side is counted per id before the join."""
    pages = html.groupBy(key).agg(F.count(F.lit(1)).alias("html_files"))
    docs = documents.groupBy(key).agg(F.count(F.lit(1)).alias("json_files"))
    state = (
        F.when(F.col("html_files").isNull(), F.lit("json_only"))
        .when(F.col("json_files").isNull(), F.lit("html_only"))
        .otherwise(F.lit("both"))
    )
    return (
        pages.join(docs, key, "full_outer")
        .withColumn("state", state)
        .fillna(0, ["html_files", "json_files"])
    )


def url_file_map(pages: DataFrame, url: str = "url", item: str = "item_id") -> DataFrame:
    """URL to stored file name '<item_id>_<12 hex of md5(url)>.html.gz'."""
    name = F.concat(F.concat_ws("_", F.col(item), F.substring(F.md5(url), 1, 12)), F.lit(".html.gz"))
    return pages.select(F.col(url).alias("url"), name.alias("filename"))


def join_on_file(pages: DataFrame, files: DataFrame, url: str = "url", item: str = "page_id") -> DataFrame:
    """Each page with its stored file. A page that was fetched n times has n rows in the map, which carry its item in their names;
    the join goes by both, and repeated rows of the map count once, so it stays at one row for each row of `pages`."""
    named = files.select(url, "filename", F.substring_index("filename", "_", 1).alias("_item")).distinct()
    return pages.join(named, (pages[url] == named[url]) & (pages[item].cast("string") == named["_item"])).drop(named[url]).drop("_item")


def union_outputs(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all chunks, instances or regions; a column missing somewhere is null there."""
    whole = tables[0]
    for other in tables[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole


def overlaps(assigned: DataFrame, key: str = "url", owner: str = "instance") -> DataFrame:
    """Keys handled by more than one owner."""
    owners = assigned.groupBy(key).agg(F.count_distinct(owner).alias("owners"))
    return owners.where(F.col("owners") > 1)
