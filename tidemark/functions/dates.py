"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of the eight lunar phases from the new moon on, lunations a day, and the lunation's place on 2001-01-01.
PHASES = ["New Moon", "Waxing Crescent", "First Quarter", "Waxing Gibbous", "Full Moon", "Waning Gibbous", "Last Quarter", "Waning Crescent"]
LUNATIONS_PER_DAY, LUNATION_2001 = 0.03386319269, 0.20439731


def month_start(day: Column) -> Column:
    """CAL1: first day of the month."""
    return F.trunc(day, "MM")


def week_monday(day: Column) -> Column:
    """CAL8: Monday of the ISO week."""
    return F.date_trunc("week", day).cast("date")


def either_date(text: Column) -> Column:
    """SRC21: yyyy-MM-dd or MM/dd/yyyy; anything else that isn't null is an error."""
    day = F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "MM/dd/yyyy"))
    return F.when(text.isNull() | day.isNotNull(), day).otherwise(F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date"))


def moon_phase(at: Column) -> Column:
    """IND12: name of the lunar phase at a time."""
    days = (F.unix_seconds(at.cast("timestamp")) - F.lit(978_307_200)) / F.lit(86_400.0)
    place = F.pmod(days * LUNATIONS_PER_DAY + LUNATION_2001, F.lit(1.0))
    index = F.floor(place * 8 + 0.5).cast("int").bitwiseAND(7)
    return F.element_at(F.array(*map(F.lit, PHASES)), index + 1)


def cyclical(month: Column) -> tuple[Column, Column]:
    """IND10: sine and cosine of the month's place in the year."""
    angle = month * F.lit(2 * 3.141592653589793 / 12)
    return F.sin(angle), F.cos(angle)


def quarter_month(roman: Column) -> Column:
    """First month of quarter I to IV; null for others."""
    return F.when(roman == "I", 1).when(roman == "II", 4).when(roman == "III", 7).when(roman == "IV", 10)
