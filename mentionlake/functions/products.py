"""Expressions over the product reference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionlake.functions.text import col

# Fixed value: factor from the currency of the reference to US dollars.
USD_FACTOR = 0.011

# Upper bounds of the price segments.
BUDGET_BELOW = 20000
MIDRANGE_BELOW = 50000


def as_flag(c: Column | str) -> Column:
    return F.coalesce(col(c) == 1, F.lit(False))


def price_segment(c: Column | str) -> Column:
    """A missing price falls through to the last segment."""
    return (
        F.when(col(c) < BUDGET_BELOW, "Budget")
        .when(col(c) < MIDRANGE_BELOW, "Midrange")
        .otherwise("Flagship")
    )
