"""Exact rounded ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Wide enough for a sum of longs and for a sum of DECIMAL(18,2), and the scaled numerator still
# fits into Spark's 38 digits.
_WIDE = "decimal(28,4)"


def safe_ratio(numerator: Column, denominator: Column, scale: int = 2, factor: int = 1) -> Column:
    """``ROUND(numerator / NULLIF(denominator, 0) * factor, scale)``, half away from zero.

    Rounded by integer division on decimals. A decimal quotient that is rounded afterwards would
    round twice, and a double quotient depends on the order of summation.
    """
    top = F.abs(numerator.cast(_WIDE))
    bottom = F.abs(F.nullif(denominator, F.lit(0)).cast(_WIDE))
    units = F.call_function(
        "div", top * F.lit(Decimal(2 * factor * 10**scale)) + bottom, bottom * F.lit(Decimal(2))
    )
    negative = (numerator < 0) != (denominator < 0)
    step = Decimal(1).scaleb(-scale)
    return (F.when(negative, -units).otherwise(units).cast("decimal(18,0)") * F.lit(step)).cast(
        f"decimal({18 + scale},{scale})"
    )


def percentage(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    return safe_ratio(numerator, denominator, scale, factor=100)
