"""Scalar KPI expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Tier


def ratio(part: Column, whole: Column, scale: int = 1) -> Column:
    """``part / whole * scale``, 0 where the denominator is not positive."""
    value = part.cast("double") / F.when(whole > 0, whole.cast("double")) * F.lit(float(scale))
    return F.coalesce(value, F.lit(0.0))


def tier(value: Column, bounds: Tier) -> Column:
    return (
        F.when(value >= F.lit(bounds.safe), "Safe")
        .when(value >= F.lit(bounds.warning), "Warning")
        .otherwise("Exit")
    )


def price_of(product: Column, prices: dict[str, int]) -> Column:
    """Price of a product; 0 for an unknown or NULL product."""
    if not prices:
        return F.lit(0).cast("long")
    table = F.create_map(*(F.lit(x) for x in chain.from_iterable(prices.items())))
    return F.coalesce(table[product], F.lit(0)).cast("long")


def burned(delta: Column) -> Column:
    """Amount spent by a negative movement, else 0."""
    return F.greatest(-delta, F.lit(0))
