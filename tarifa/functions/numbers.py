"""Exact decimals: percentiles and the suspect-price rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarifa.config import Settings


def decimal_percentile(value: Column, share: float, frequency: Column | None = None, precision: int = 8) -> Column:
    """Continuous percentile of a DECIMAL(n,3), as a decimal cut toward zero at the third digit.

    Works on whole thousandths, so that interpolation is exact; the cast to bigint drops the half.
    """
    weights = [] if frequency is None else [frequency]
    return cut_thousandths(F.percentile((value * 1000).cast("bigint"), F.lit(share), *weights), precision)


def cut_thousandths(value: Column, precision: int = 8) -> Column:
    """A number of thousandths, which may have a half, as a decimal cut toward zero."""
    return (value.cast("bigint").cast("decimal(20,0)") / 1000).cast(f"decimal({precision},3)")


def is_suspect(fuel: Column, price: Column, settings: Settings) -> Column:
    """True for a price at petrol level on a fuel that costs far less; NULL if that price is NULL."""
    flag = None
    for code, limit in settings.suspect_above.items():
        above = price > F.lit(limit)
        flag = F.when(fuel == code, above) if flag is None else flag.when(fuel == code, above)
    return F.lit(False) if flag is None else flag.otherwise(F.lit(False))
