"""Null-safe arithmetic and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(x: Column) -> Column:
    """Numeric value or NULL (never an ANSI error)."""
    return x.try_cast("double")


def finite_or(x: Column, default: float) -> Column:
    """`x`, or `default` for NULL and NaN."""
    return F.coalesce(F.nanvl(x, F.lit(float(default))), F.lit(float(default)))


def positive_part(x: Column) -> Column:
    """max(x, 0) that keeps NULL."""
    return F.when(x > 0, x).when(x.isNotNull(), F.lit(0.0))


def fixed(x: Column, digits: int, comma: bool = False, plus: bool = False) -> Column:
    """Fixed-point text: half-even on the exact binary value, optional thousands commas and sign."""
    text = F.format_number(x, digits)
    if not comma:
        text = F.replace(text, F.lit(","), F.lit(""))
    if plus:
        text = F.when(F.startswith(text, F.lit("-")), text).otherwise(F.concat(F.lit("+"), text))
    return text


def shortest(x: Column) -> Column:
    """Plain decimal text of a rounded double without a trailing '.0'."""
    return F.regexp_replace(x.cast("decimal(38,6)").cast("string"), r"\.?0+$", "")


def compact_usd(x: Column) -> Column:
    """$1.2T / $3.4B / $5.6M / $7K / $8; one decimal below ten units of T, B and M."""

    def scaled(unit: float, suffix: str) -> Column:
        v = x / unit
        text = F.when(x >= 10 * unit, fixed(v, 0)).otherwise(fixed(v, 1))
        return F.concat(F.lit("$"), text, F.lit(suffix))

    return (
        F.when(x.isNull() | F.isnan(x), F.lit("-"))
        .when(x >= 1e12, scaled(1e12, "T"))
        .when(x >= 1e9, scaled(1e9, "B"))
        .when(x >= 1e6, scaled(1e6, "M"))
        .when(x >= 1e3, F.concat(F.lit("$"), fixed(x / 1e3, 0), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), fixed(x, 0)))
    )


def price_text(x: Column) -> Column:
    """Price whose precision follows its size: grouped above 1000, four significant digits below 0.01. A minus stays in front."""
    sign, x = F.when(x < 0, F.lit("-")).otherwise(F.lit("")), F.abs(x)
    grouped = F.regexp_replace(F.regexp_replace(fixed(x, 2, comma=True), "0+$", ""), r"\.$", "")
    digits = F.lit(3) - F.floor(F.log10(x)).cast("int")
    small = F.when(x == 0, F.lit("0.000")).otherwise(F.call_function("format_number", x, digits))
    body = (
        F.when(x >= 1000, grouped).when(x >= 1, fixed(x, 2)).when(x >= 0.01, fixed(x, 4)).otherwise(small)
    )
    return F.when(x.isNull() | F.isnan(x), F.lit("-")).otherwise(F.concat(sign, F.lit("$"), body))
