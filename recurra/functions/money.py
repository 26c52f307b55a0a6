"""Exact money: text to decimal, whole cents for fast sums, and ratios rounded without floating point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recurra.schemas import MONEY

_WIDE = "decimal(38,0)"


def parse_amount(raw: Column) -> Column:
    """'$1,234.00' to 1234.00; text that is no number becomes NULL."""
    return F.trim(F.translate(raw, "$,", "")).try_cast(MONEY)


def is_formatted_amount(raw: Column) -> Column:
    return F.coalesce(raw.contains("$") | raw.contains(","), F.lit(False))


def to_cents(amount: Column) -> Column:
    """Decimal money as BIGINT cents: sums of longs stay in generated code, wide decimals do not."""
    return (amount * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(20,2)")


def rounded_units(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator in units of 10^-digits, half away from zero, as BIGINT.

    Both are whole numbers and the denominator is positive; a zero denominator gives NULL.
    """
    top, bottom = numerator.cast(_WIDE), F.nullif(denominator.cast(_WIDE), F.lit(0).cast(_WIDE))
    doubled = F.abs(top) * F.lit(2 * 10**digits).cast("decimal(10,0)") + bottom
    size = F.call_function("div", doubled.cast(_WIDE), (bottom * 2).cast(_WIDE))
    return F.when(top < 0, -size).otherwise(size)


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """The same as an exact decimal with `digits` decimal places."""
    units = rounded_units(numerator, denominator, digits)
    return (units.cast("decimal(18,0)") / F.lit(10**digits)).cast(f"decimal(18,{digits})")


def rounded_percent(part: Column, whole: Column, digits: int) -> Column:
    return rounded_ratio(part.cast(_WIDE) * 100, whole, digits)
