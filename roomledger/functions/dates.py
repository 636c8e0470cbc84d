"""Period columns derived from a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last day of the year of each season.
SPRING_DAYS = (79, 171)
SUMMER_DAYS = (172, 263)
AUTUMN_DAYS = (264, 354)
WINTER_DAYS = ((1, 78), (355, 366))


GRAINS = ("name", "year_month")


def month_key(date: Column | str, grain: str = "name") -> Column:
    """Cheap key of a month to group by: its number, merging years, or its first day."""
    if grain not in GRAINS:
        raise ValueError(f"month grain must be one of {GRAINS}, not {grain!r}")
    return F.month(date) if grain == "name" else F.trunc(date, "MM")


def month_label(key: Column | str, grain: str = "name") -> Column:
    """Text of a :func:`month_key`: the month's name, or ``yyyy-MM``.

    Formatting the groups instead of the days saves most of the work.
    """
    if grain == "name":
        return F.date_format(F.make_date(F.lit(2000), key, F.lit(1)), "MMMM")
    return F.date_format(key, "yyyy-MM")


def season_of(date: Column | str) -> Column:
    """Season by day of the year; null for a null date."""
    day = F.dayofyear(date)
    winter = day.between(*WINTER_DAYS[0]) | day.between(*WINTER_DAYS[1])
    return (
        F.when(day.between(*SPRING_DAYS), "Spring")
        .when(day.between(*SUMMER_DAYS), "Summer")
        .when(day.between(*AUTUMN_DAYS), "Autumn")
        .when(winter, "Winter")
    )
