"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pushes decimal ties off the tie, so that engines which round doubles differently agree.
NUDGE = 1e-9


def fixed(value: Column, digits: int = 4) -> Column:
    return F.round(value + F.lit(NUDGE), digits)


def to_number(text: Column) -> Column:
    """Text as a double; null where it isn't a finite number."""
    number = F.expr("1").cast("double") * text.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def pct_change(now: Column, before: Column) -> Column:
    """Percent change; null for a zero base."""
    return F.try_divide(now - before, before) * 100


def clip(value: Column, lo: Column | float, hi: Column | float) -> Column:
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(value.isNotNull(), F.least(F.greatest(value, lo), hi))


def ordered_interval(mid: Column, lo: Column, hi: Column, floor: Column, ceiling: Column) -> tuple[Column, Column, Column]:
    """IND21: mid, lo, hi clipped to [floor, ceiling], then lo <= mid <= hi."""
    m = clip(mid, floor, ceiling)
    return m, F.least(clip(lo, floor, ceiling), m), F.greatest(clip(hi, floor, ceiling), m)


def plain_number(value: Column) -> Column:
    """Short text of a number: millions with M, thousands with separators, two digits."""
    return (
        F.when(value.isNull(), F.lit("—"))
        .when(F.abs(value) >= 1e6, F.concat(F.format_number(value / 1e6, 2), F.lit("M")))
        .otherwise(F.format_number(value, 2))
    )


def without_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def unit_number(value: Column, unit: Column) -> Column:
    """IND20: text of a value in its unit: thousands of persons, billions, millions, percent, else by magnitude."""
    u = F.lower(unit)
    billions = u.startswith("b ") | u.isin("b $", "b chained $")
    millions = u.startswith("m ") | u.isin("m $", "m chained $")
    return (
        F.when(value.isNull(), F.lit("—"))
        .when(u.contains("k persons"), F.concat(F.format_number(value, 0), F.lit("K")))
        .when(billions, F.concat(F.lit("$"), F.format_number(value, 1), F.lit("B")))
        .when(millions, F.concat(F.lit("$"), F.format_number(value, 0), F.lit("M")))
        .when(unit.isin("%", "%pts"), F.concat(without_commas(F.format_number(value, 2)), F.lit("%")))
        .when(value >= 10_000, F.format_number(value, 0))
        .when(value >= 100, without_commas(F.format_number(value, 2)))
        .otherwise(without_commas(F.format_number(value, 4)))
    )
