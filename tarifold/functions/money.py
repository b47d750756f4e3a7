"""Price arithmetic on doubles, and the two-decimal text of a price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import settings as S


def net_price(c: Column, vat: float = S.VAT_RATE) -> Column:
    return c / F.lit(vat)


def flat_export_price(c: Column, vat: float = S.VAT_RATE, markup: float = S.DEFAULT_MARKUP) -> Column:
    return net_price(c, vat) * F.lit(markup)


def to_95(c: Column) -> Column:
    """Nearest price that ends in .95."""
    return F.floor(c + F.lit(0.55)) - F.lit(0.05)


def cents(c: Column) -> Column:
    """Rounded to two decimals, half up."""
    return F.floor(c * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def tenths(c: Column) -> Column:
    """Rounded to one decimal, half up."""
    return F.floor(c * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def money_text(c: Column) -> Column:
    """``12.50``; NULL stays NULL (a bare format would print the word null)."""
    return F.when(c.isNotNull(), F.format_string("%.2f", cents(c)))


def percent_text(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.1f", c))


def percentile(prices: Column, p: float) -> Column:
    """Linear-interpolation percentile of a non-empty array."""
    ordered = F.sort_array(prices)
    n = F.size(prices)
    position = F.lit(p) * (n - 1)
    low = F.floor(position).cast("int")
    at_low = F.try_element_at(ordered, low + 1)
    at_high = F.try_element_at(ordered, low + 2)
    return F.when(low + 1 >= n, F.try_element_at(ordered, n)).otherwise(
        at_low + (position - low) * (at_high - at_low)
    )


def array_mean(prices: Column) -> Column:
    """Mean in array order; NULL for an empty array."""
    total = F.aggregate(prices, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(prices) > 0, total / F.size(prices))
