"""Lenient parsers: text -> typed value, null on anything malformed, never an error.

Spark 4 runs with ANSI mode on, where a plain ``cast``/``to_date`` on bad text raises. The registry dumps
this library targets are full of blanks, zero dates and decimal commas, so every parser here is built
from the ``try_*`` forms and stays a native (codegen'd) expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import as_col


DIGITS = "0123456789"
# What may stand in a number beside its digits (a cast ignores blanks and control characters around it).
_BESIDE_DIGITS = ".+- " + "".join(chr(x) for x in (*range(0x20), 0x7F))


def _only(c: Column, chars: str) -> Column:
    """Whether a text has no other characters than ``chars`` (no regex, no copy of the text)."""
    return F.octet_length(F.ltrim(c, F.lit(chars))) == 0


def _lenient_whole(c: Column, dtype: str) -> Column:
    # A try_cast that fails throws and catches an exception, at the cost of some hundred casts: texts that
    # cannot be numbers never reach it. The regex runs on texts with a point only.
    number = F.when(F.contains(c, F.lit(".")), F.regexp_replace(F.trim(c), r"\.[0-9]*$", "")).otherwise(c)
    return F.when(_only(c, DIGITS + _BESIDE_DIGITS) & ~_only(c, _BESIDE_DIGITS), number.try_cast(dtype))


def lenient_int(c) -> Column:
    """Text -> int. ``' 7 '`` -> 7, ``'12.7'`` -> 12, ``'-3.9'`` -> -3; blank, ``'x'``, ``'44,00'``, overflow -> null.

    A fractional part is dropped (truncation toward zero, as a non-ANSI cast does) before a ``try_cast``.
    """
    return _lenient_whole(as_col(c), "int")


def lenient_long(c) -> Column:
    """As :func:`lenient_int`, to bigint."""
    return _lenient_whole(as_col(c), "bigint")


def lenient_double(c, decimal_comma: bool = False) -> Column:
    """Text -> double, null when malformed. With ``decimal_comma`` a ``,`` is read as the decimal mark."""
    c = as_col(c)
    if decimal_comma:
        c = F.replace(c, F.lit(","), F.lit("."))
    return c.try_cast("double")


def decimal_comma(c, dtype: str = "float") -> Column:
    """``'1234567,89'`` -> 1234567.875 (float) or an exact ``decimal(18,2)``; ``'1.234,5'`` -> null."""
    return F.replace(as_col(c), F.lit(","), F.lit(".")).try_cast(dtype)


def lenient_date(c, fmt: str = "yyyyMMdd") -> Column:
    """``'20210228'`` -> 2021-02-28; ``'00000000'``, ``'20210230'``, ``''``, short text -> null.

    In the default format, eight digits are cut into year, month and day and cast, and zero dates, months and days
    out of range and shorter texts are null at once: the formatter throws an exception for each of them.
    """
    c = as_col(c)
    if fmt != "yyyyMMdd":
        return F.try_to_date(c, fmt)
    year, month, day = F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)
    cast = F.when(month.between("01", "12") & day.between("01", "31"), F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date"))
    return F.when(F.octet_length(c) < 8, F.lit(None)).when((F.octet_length(c) == 8) & _only(c, DIGITS), cast).otherwise(F.try_to_date(c, fmt))


def year_month(c, fmt: str = "yyyyMM") -> Column:
    """``'202103'`` -> 2021-03-01 (first day of the month); anything else -> null."""
    return F.try_to_date(as_col(c), fmt)
