"""Money arithmetic in DECIMAL, exposed as DOUBLE at table boundaries.

Sums of doubles depend on the order rows arrive in; decimal sums do not, so the
same table gives the same totals however Spark partitions it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CENTS = "decimal(18,2)"
_WIDE = "decimal(28,2)"


def to_pln(amount: Column, rate: Column) -> Column:
    """``amount * rate`` rounded half up to two places, once, from the exact product.

    NULL for amounts of 1e12 or more, which the range rule always rejects.
    """
    exact = amount.try_cast("decimal(27,15)") * rate.cast("decimal(10,6)")
    return F.round(exact, 2).cast("double")


def total(amount: Column) -> Column:
    """Exact sum of a two-place money column; amounts beyond 16 digits are left out."""
    return F.sum(amount.try_cast(_CENTS)).cast("double")


def mean(amount: Column) -> Column:
    """Average of a money column, rounded half up to two places; amounts of 1e26 or more are left out."""
    wide = amount.try_cast(_WIDE)
    return F.round(F.sum(wide) / F.nullif(F.count(wide), F.lit(0)), 2).cast("double")


def sums(amount: Column, prefix: str) -> list[Column]:
    """What ``total`` and ``mean`` of parts need to be merged, and how many amounts neither takes."""
    wide = amount.try_cast(_WIDE)
    return [
        F.sum(amount.try_cast(_CENTS)).alias(f"{prefix}_cents"),
        F.sum(wide).alias(f"{prefix}_wide"),
        F.count(wide).alias(f"{prefix}_counted"),
        F.count_if(amount.isNotNull() & amount.try_cast(_CENTS).isNull()).alias(f"{prefix}_unfit"),
    ]


def merged_total(prefix: str) -> Column:
    return F.sum(f"{prefix}_cents").cast("double")


def merged_mean(prefix: str) -> Column:
    return F.round(F.sum(f"{prefix}_wide") / F.nullif(F.sum(f"{prefix}_counted"), F.lit(0)), 2).cast("double")


def rate(part: Column, whole: Column, places: int = 5) -> Column:
    """``part / whole`` rounded; NULL when ``whole`` is zero."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)), places)
