"""Exact money arithmetic.

Measures travel as whole cents in BIGINT, so products, sums and partial sums stay
in primitive longs inside generated code and are exact in any order. They turn
into decimals or doubles only in the last projection, once per group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(x) -> Column:
    """A two-place amount (double or decimal) as whole cents."""
    return F.round(_col(x) * 100).cast("bigint")


def amount(x) -> Column:
    """Whole cents as a double with two places."""
    return _col(x) / F.lit(100.0)


def half_up(n, d) -> Column:
    """``n / d`` rounded half away from zero to an integer; NULL when d = 0."""
    wide = "decimal(34,0)"
    n, d = _col(n).cast(wide), F.nullif(_col(d), F.lit(0)).cast(wide)
    size = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.sign(n).cast("bigint") * size


def mean_amount(total_cents, count) -> Column:
    """Mean of a cents total, rounded to two places."""
    return amount(half_up(total_cents, count))


def percent(part, whole) -> Column:
    """``100 * part / whole`` rounded to two places."""
    return amount(half_up(_col(part).cast("decimal(34,0)") * 10000, whole))


def ratio(n, d, places: int = 4) -> Column:
    """``n / d`` rounded half up to ``places``, exact before the final double."""
    scale = 10**places
    return half_up(_col(n).cast("decimal(34,0)") * scale, d) / F.lit(float(scale))


def as_decimal(x, precision: int = 12) -> Column:
    """Whole cents as DECIMAL(precision, 2), for columns of a stored table."""
    return (_col(x).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        f"decimal({precision},2)"
    )
