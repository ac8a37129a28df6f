"""Training tables derived from URL features, the split, the sample, and text reports.

Every builder keeps the URL, so tables can be joined again and split consistently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.ordering import sample_per_stratum


def category_table(features: DataFrame) -> DataFrame:
    return features.select("url", "item_description", "all_terms", "primary_category", "secondary_category")


def item_type_table(features: DataFrame) -> DataFrame:
    typed = features.where(F.col("tertiary_category").isNotNull())
    return typed.select("url", "item_description", "all_terms", F.col("tertiary_category").alias("item_type"))


def era_table(features: DataFrame) -> DataFrame:
    dated = features.where(F.col("decade").isNotNull())
    return dated.select("url", "item_description", "all_terms", F.col("decade").alias("primary_decade"))


def depth_table(features: DataFrame) -> DataFrame:
    return features.select(
        "url", "all_terms", F.array_join("hyphenated_terms", " ").alias("hyphenated_terms"), "depth_level"
    )


def text_table(features: DataFrame) -> DataFrame:
    """The slug, the terms, and the hyphenated terms of each URL as separate rows; empty forms are left out."""
    forms = F.array("item_description", "all_terms", F.array_join("hyphenated_terms", " "))
    forms = F.filter(forms, lambda t: t.isNotNull() & (t != ""))
    return features.select(
        F.explode(forms).alias("text"),
        "url",
        "primary_category",
        "secondary_category",
        F.coalesce("decade", F.lit(0)).alias("decade"),
    )


def sequence_table(features: DataFrame) -> DataFrame:
    """Each proper prefix of the path with the segment that follows it."""
    seg = F.col("path_segments")
    lengths = features.where(F.size(seg) > 1).select(
        "url", "path_segments", F.explode(F.sequence(F.lit(1), F.size(seg) - 1)).alias("sequence_length")
    )
    return lengths.select(
        F.array_join(F.slice("path_segments", F.lit(1), F.col("sequence_length")), " ").alias("sequence"),
        F.get("path_segments", F.col("sequence_length")).alias("target"),
        "sequence_length",
        "url",
    )


def split_name(url: Column, train: int = 70, validation: int = 10) -> Column:
    """Train, validation or test by a hash of the URL: all rows of one URL fall together."""
    bucket = F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("long") % 100
    return (
        F.when(bucket < train, F.lit("train"))
        .when(bucket < train + validation, F.lit("validation"))
        .otherwise(F.lit("test"))
    )


def with_split(table: DataFrame, url: str = "url") -> DataFrame:
    return table.withColumn("split", split_name(F.col(url)))


def mini_sample(features: DataFrame, fraction: float = 0.1, stratum: str = "secondary_category") -> DataFrame:
    return sample_per_stratum(features, stratum, F.col("url"), fraction)


def image_pairs(products: DataFrame, label: str = "category") -> DataFrame:
    """One row per product image with the label."""
    return products.select(
        "product_id", F.posexplode("images").alias("image_index", "image"), F.col(label).alias("label")
    )


def taxonomy(products: DataFrame) -> DataFrame:
    """Image rows for the four label sets: category, materials, style or period, and all together."""
    labels = F.array(
        F.struct(F.lit("category").alias("label_set"), F.array_compact(F.array("category")).alias("labels")),
        F.struct(F.lit("materials").alias("label_set"), F.col("materials").alias("labels")),
        F.struct(F.lit("style_period").alias("label_set"), F.array_compact(F.array("style", "period")).alias("labels")),
        F.struct(
            F.lit("multi_label").alias("label_set"),
            F.concat(
                F.array_compact(F.array("category")), "materials", F.array_compact(F.array("style", "period"))
            ).alias("labels"),
        ),
    )
    images = products.select("product_id", F.explode("images").alias("image"), labels.alias("sets"))
    return images.select("product_id", "image", F.inline("sets"))


def term_counts(df: DataFrame, terms: str) -> DataFrame:
    return df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def bigrams(terms: Column) -> Column:
    """Neighbouring pairs of a term list."""
    n = F.size(terms)
    first = F.slice(terms, F.lit(1), F.greatest(n - 1, F.lit(0)))
    return F.zip_with(first, F.slice(terms, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def term_patterns(df: DataFrame, terms: str) -> DataFrame:
    """Frequency of single terms and of neighbouring pairs, in one pass."""
    both = F.concat(
        F.transform(F.col(terms), lambda t: F.struct(F.lit(1).alias("size"), t.alias("term"))),
        F.transform(bigrams(F.col(terms)), lambda t: F.struct(F.lit(2).alias("size"), t.alias("term"))),
    )
    return df.select(F.inline(both)).groupBy("size", "term").agg(F.count(F.lit(1)).alias("n"))
