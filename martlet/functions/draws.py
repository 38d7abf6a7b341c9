"""Deterministic draws in [0, 1) from a key and a salt.

One salt per drawn column. The draw depends on nothing but its key, so a retried
task, another partitioning or another run gives the same value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = float(2**32)


def draw(salt: str, *keys) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("-", *[c.cast("string") for c in cols])
    head = F.substring(F.md5(F.concat(text, F.lit(f":{salt}"))), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(_SPAN)


def draw_int(salt: str, low: int, high: int, *keys) -> Column:
    """Whole number in [low, high], both ends included."""
    return (F.lit(low) + F.floor(draw(salt, *keys) * (high - low + 1))).cast("bigint")


def draw_index(salt: str, size, *keys) -> Column:
    """Whole number in [0, size) for a size known only as a column."""
    return F.floor(draw(salt, *keys) * size).cast("bigint")
