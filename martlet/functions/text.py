"""Cleaning of external text: null tokens, safe casts, vocabularies, formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens a source file uses for "no value".
NULL_TOKENS = ("NULL", "null", "")
# The accepted shape of an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Spellings a loader accepts as a flag.
TRUE_WORDS, FALSE_WORDS = ("True", "true", "1"), ("False", "false", "0")


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_token(x) -> Column:
    c = _col(x)
    return F.when(c.isin(*NULL_TOKENS), F.lit(None)).otherwise(c)


def clean(x) -> Column:
    return F.trim(_col(x))


def code(x) -> Column:
    return F.upper(F.trim(_col(x)))


def digits(x) -> Column:
    return F.regexp_replace(_col(x), "[^0-9]", "")


def to_type(x, data_type: str) -> Column:
    """Cast that yields NULL, not an error, for text that does not parse.

    Whole numbers may be written with decimals ("3.0"), which are rounded away.
    """
    if data_type == "bigint":
        return _col(x).try_cast("decimal(38,0)").try_cast("bigint")
    return _col(x).try_cast(data_type)


def flag(x, default: bool) -> Column:
    """Map the loader's flag spellings; anything else takes the default."""
    c = _col(x)
    return (
        F.when(c.isin(*TRUE_WORDS), F.lit(True))
        .when(c.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default))
    )


def is_email(x) -> Column:
    return _col(x).rlike(EMAIL_PATTERN)


def cut(x, n: int) -> Column:
    return F.substring(_col(x), 1, n)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def one_place(x: Column) -> Column:
    """A double as text with one decimal, rounded from its exact binary value.

    20 * y = 16 * y + 4 * y is carried with its rounding error, so the comparison
    with the midpoint between two tenths is exact; true ties go to the even digit.
    """

    def tenths(v: Column) -> Column:
        def rounded(total: Column) -> Column:
            low = F.floor(total / 2)
            error = F.abs(v) * 4.0 - (total - F.abs(v) * 16.0)
            beyond = (total - (low * 2 + 1)) + error
            return low + F.when((beyond > 0) | ((beyond == 0) & (low % 2 == 1)), 1).otherwise(0)

        return _bind(F.abs(v) * 16.0 + F.abs(v) * 4.0, rounded)

    def text(v: Column) -> Column:
        sign = F.when(v < 0, "-").otherwise("")
        return _bind(
            tenths(v),
            lambda n: F.concat(
                sign, F.floor(n / 10).cast("string"), F.lit("."), (n % 10).cast("string")
            ),
        )

    return _bind(x, text)


def _suffixed(x: Column, prefix: str) -> Column:
    def text(v: Column) -> Column:
        size = F.abs(v)
        unit = F.when(size >= 1e9, 1e9).when(size >= 1e6, 1e6).otherwise(1e3)
        suffix = F.when(size >= 1e9, "B").when(size >= 1e6, "M").otherwise("K")
        return (
            F.when(v.isNull(), F.lit(f"{prefix}0"))
            .when(size >= 1e3, F.concat(F.lit(prefix), one_place(v / unit), suffix))
            .otherwise(F.concat(F.lit(prefix), F.format_string("%,.0f", F.rint(v))))
        )

    return _bind(x, text)


def currency_text(x) -> Column:
    """``$1.2K`` / ``$3.4M`` / ``$5.6B``; whole dollars below a thousand."""
    return _suffixed(_col(x).cast("double"), "$")


def number_text(x) -> Column:
    return _suffixed(_col(x).cast("double"), "")


def percent_text(x) -> Column:
    c = _col(x).cast("double")
    return F.when(c.isNull(), F.lit("0.0%")).otherwise(F.concat(one_place(c), F.lit("%")))
