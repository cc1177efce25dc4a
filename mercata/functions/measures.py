"""Exact ratios, shares and means.

A quotient of two wide decimals is squeezed to scale 6 by Spark, and rounding that
to four digits rounds twice. Both sides are therefore cast to ``decimal(20,2)``
first, which leaves at least 14 digits behind the point.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(20,2)"


def _wide(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(WIDE)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null when the denominator is zero or either side is null."""
    return _wide(numerator) / F.nullif(_wide(denominator), F.lit(0).cast(WIDE))


def rounded_ratio(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    return F.round(ratio(numerator, denominator), digits)


def pct(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    """``100 * numerator / denominator`` rounded half up."""
    scaled = _wide(numerator) * F.lit(100)
    return F.round(scaled / F.nullif(_wide(denominator), F.lit(0).cast(WIDE)), digits)


def cents(amount: Column | str) -> Column:
    """Money as whole cents: sums of long integers are exact and need half the room of wide decimals."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return (amount * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    """Summed cents as money."""
    return (total.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(WIDE)
