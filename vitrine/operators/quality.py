"""Predicates with reasons. Rejected rows are labelled, never lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import money

MIN_PAGE_BYTES = 10_000
MAX_PAGE_BYTES = 10_485_760
MAX_IMAGES = 20
MAX_PRICE = 10_000_000
MAX_TITLE = 500
MAX_DESCRIPTION = 5000

# Error class, response, retries, wait, log level.
FETCH_POLICY = [
    ("connection_error", "retry", 3, "exponential 4-10s", "ERROR"),
    ("not_found", "skip", 0, "none", "WARN"),
    ("rate_limit", "delay", 0, "delay +50%", "WARN"),
    ("server_error", "retry", 3, "fixed 10s", "ERROR"),
    ("timeout", "retry", 2, "none", "WARN"),
    ("parse_error", "skip", 0, "none", "ERROR"),
    ("disk_full", "abort", 0, "none", "CRITICAL"),
]


def _escaped(host: str) -> str:
    return host.replace(".", r"\.")


def is_listing_url(url: Column, host: str) -> Column:
    """The URL starts with https, the host, at least one path character and then a numeric id."""
    return url.rlike(rf"^https://{_escaped(host)}/.*/id-f_\d+/")


def url_reject_reason(url: Column, host: str) -> Column:
    """First rule the URL breaks, or null."""
    return (
        F.when(~F.startswith(F.lower(url), F.lit("https://")), F.lit("scheme"))
        .when(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1) != host, F.lit("host"))
        .when(~url.rlike(r"/id-f_\d+/"), F.lit("no id"))
        .when(F.contains(url, F.lit("..")) | F.contains(F.substr(url, F.lit(9)), F.lit("//")), F.lit("path"))
    )


def content_reject_reason(
    status: Column, content_type: Column, size: Column, low: int = MIN_PAGE_BYTES, high: int = MAX_PAGE_BYTES
) -> Column:
    return (
        F.when(status.isNull() | (status != 200), F.lit("status"))
        .when(~F.contains(F.coalesce(content_type, F.lit("")), F.lit("text/html")), F.lit("content_type"))
        .when(size < low, F.lit("too_small"))
        .when(size > high, F.lit("too_large"))
    )


def error_class(status: Column, error: Column) -> Column:
    """Class of a fetch outcome; null for a success."""
    known = [name for name, *_ in FETCH_POLICY]
    return (
        F.when(error.isin(known), error)
        .when(status == 404, F.lit("not_found"))
        .when(status == 429, F.lit("rate_limit"))
        .when(status.between(500, 599), F.lit("server_error"))
        .when(status != 200, F.lit("unexpected_status"))
    )


def fetch_policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        FETCH_POLICY, "error_class string, response string, retries int, wait string, log_level string"
    )


def classify_fetch(outcomes: DataFrame, status: str = "status", error: str = "error") -> DataFrame:
    """Add error class and retry policy. The policy is a fixed table of seven rows, hence the broadcast."""
    classed = outcomes.withColumn("error_class", error_class(F.col(status), F.col(error)))
    return classed.join(F.broadcast(fetch_policy(outcomes.sparkSession)), "error_class", "left")


def _reasons(rules: list[tuple[Column, str]]) -> Column:
    """Names of the rules that do not hold; a rule that is null does not hold."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for holds, name in rules])
    )


def product_failures(
    has_info: Column, product_id: Column, images: Column, pricing: Column, price: Column,
    title: Column | None = None, description: Column | None = None,
) -> Column:
    """Every rule an extracted product breaks. The lengths are rules; no value is cut to them."""
    amount = money.parse_money(price)
    long = [(x, n, r) for x, n, r in ((title, MAX_TITLE, "title_too_long"), (description, MAX_DESCRIPTION, "description_too_long")) if x is not None]
    return _reasons(
        [
            (has_info, "product_info"),
            (product_id.isNotNull(), "product_id"),
            (F.startswith(product_id, F.lit("f_")), "id_prefix"),
            (images.isNotNull(), "images_list"),
            (F.coalesce(F.size(images), F.lit(0)) <= MAX_IMAGES, "too_many_images"),
            (pricing.isNotNull(), "pricing_map"),
            ((amount > 0) & (amount < MAX_PRICE), "price_range"),
            *[(F.coalesce(F.length(x), F.lit(0)) <= n, rule) for x, n, rule in long],
        ]
    )


def required_failures(product_id: Column, title: Column, price: Column) -> Column:
    """Required values that are absent or empty."""
    return _reasons(
        [(truthy(product_id), "product_id"), (truthy(title), "title"), (truthy(price), "price")]
    )


def truthy(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def truthy_list(value: Column) -> Column:
    return value.isNotNull() & (F.size(value) > 0)


def health_warnings(
    success_rate: Column, memory_mb: Column, startup_seconds: Column, cpu_percent: Column
) -> Column:
    """Warning signs of a chunk run."""
    return F.array_compact(
        F.array(
            F.when(success_rate < 0.5, F.lit("success_below_50")),
            F.when(memory_mb > 1024, F.lit("memory_above_1gb")),
            F.when(startup_seconds > 30, F.lit("startup_above_30s")),
            F.when(cpu_percent > 80, F.lit("cpu_above_80")),
        )
    )


# Columns that name no person, object, seller or price. Anything else, nested or new, stays out.
PUBLIC_COLUMNS = ["product_id", "category", "condition", "period", "decade", "depth_level", "split", "chunk_id"]


def without_private(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The public columns of `df`, and those that the caller knows to be public."""
    return df.select(*[c for c in df.columns if c in (*PUBLIC_COLUMNS, *also)])
