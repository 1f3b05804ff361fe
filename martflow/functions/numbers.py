"""Messy numbers in, rounded and formatted numbers out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _number(text: Column, drop: str, to: str) -> Column:
    cleaned = F.trim(F.regexp_replace(text, drop, ""))
    return F.nullif(F.nullif(cleaned, F.lit("-")), F.lit("")).try_cast(to)


def parse_money(text: Column, unit: str = "") -> Column:
    """``$3,493,860`` or ``485,000 <unit>`` as double; ``-`` and junk as null."""
    drop = rf"[$,]|\Q{unit}\E" if unit else "[$,]"
    return _number(text, drop, "double")


def parse_percent(text: Column) -> Column:
    """``-82.2%`` as the double -82.2."""
    return _number(text, "[%,]", "double")


def parse_count(text: Column) -> Column:
    """``4,350`` as bigint."""
    return _number(text, ",", "bigint")


def lenient_number(col: Column, default: float = 0, to: str = "double") -> Column:
    """A number, or ``default`` where the value is missing or not a number."""
    number = col.try_cast(to)
    if to in ("double", "float"):
        number = F.when(~F.isnan(number), number)
    return F.coalesce(number, F.lit(default).cast(to))


def round_half_even(col: Column, digits: int = 0) -> Column:
    return F.bround(col, digits)


def fmt_int(col: Column) -> Column:
    """Thousands separators on the whole part; the fraction is cut off, not rounded."""
    return F.format_number(col.cast("bigint"), 0)


def fmt_rounded(col: Column) -> Column:
    """Thousands separators on the nearest integer, ties to even."""
    return F.format_number(F.bround(col, 0).cast("bigint"), 0)


def fmt_money(col: Column) -> Column:
    return F.format_number(col, 2)


def line_revenue(quantity: Column, price: Column) -> Column:
    return quantity * price
