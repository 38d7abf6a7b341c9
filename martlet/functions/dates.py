"""Date arithmetic with boundary-counting differences and calendar columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day(d: date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def date_key(x) -> Column:
    """yyyymmdd as an integer."""
    c = _col(x)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def years_between(a, b) -> Column:
    """Number of year boundaries crossed from a to b."""
    return F.year(_col(b)) - F.year(_col(a))


def months_crossed(a, b) -> Column:
    """Number of month boundaries crossed from a to b."""
    a, b = _col(a), _col(b)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def quarter_start(x) -> Column:
    return F.trunc(_col(x), "quarter")


def quarter_end(x) -> Column:
    return F.date_sub(F.add_months(F.trunc(_col(x), "quarter"), 3), 1)


def year_end(x) -> Column:
    return F.date_sub(F.add_months(F.trunc(_col(x), "year"), 12), 1)
