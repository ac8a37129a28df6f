"""Prices written as text, and price bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Band edges and labels.
PRICE_BANDS = ([1000, 5000, 10000, 50000], ["under_1000", "1000_5000", "5000_10000", "10000_50000", "over_50000"])
PRICE_BANDS_3 = ([2000, 5000], ["under_2000", "2000_5000", "over_5000"])
NO_PRICE = "no_price"


def parse_money(price: Column) -> Column:
    """'$1,234.50' to 1234.5; null for anything that is not a plain number after '$' and ',' are dropped."""
    bare = F.translate(price, "$,", "")
    return F.when(bare.rlike(NUMBER), F.btrim(F.regexp_replace(bare, r"\s+", "")).try_cast("double"))


def amount_in_text(text: Column) -> Column:
    """The amount in a displayed price of any currency, such as '€4,831'."""
    return F.regexp_replace(text, r"[^0-9.]", "").try_cast("decimal(18,2)")


def price_band(amount: Column, edges: Sequence[float], labels: Sequence[str], missing: str | None = NO_PRICE) -> Column:
    """Label of the half-open band holding `amount`; `missing` when it is null."""
    band = F.when(amount.isNull(), F.lit(missing))
    for edge, label in zip(edges, labels, strict=False):
        band = band.when(amount < edge, F.lit(label))
    return band.otherwise(F.lit(labels[-1]))


def as_dollars(amount: Column) -> Column:
    """'$1,234.50' from a number."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))
