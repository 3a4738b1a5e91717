"""Seasons as date ranges, and dates within them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last month and day of each season; winter ends in the year after.
SEASONS = {
    "spring": ((3, 1), (5, 31)),
    "summer": ((6, 1), (8, 31)),
    "autumn": ((9, 1), (11, 30)),
    "fall": ((9, 1), (11, 30)),
    "winter": ((12, 1), (2, 28)),
    "annual": ((1, 1), (12, 31)),
    "year": ((1, 1), (12, 31)),
}


def season_window(year: Column, season: Column) -> tuple[Column, Column]:
    """First and last day of a season, both in it. Names ignore case; unknown ones mean the whole year."""
    name, year = F.lower(season), year.cast("int")
    (m1, d1), (m2, d2) = SEASONS["annual"]
    start, end = F.make_date(year, F.lit(m1), F.lit(d1)), F.make_date(year, F.lit(m2), F.lit(d2))
    for key, ((m1, d1), (m2, d2)) in SEASONS.items():
        start = F.when(name == key, F.make_date(year, F.lit(m1), F.lit(d1))).otherwise(start)
        end = F.when(name == key, F.make_date(year + (1 if (m2, d2) < (m1, d1) else 0), F.lit(m2), F.lit(d2))).otherwise(end)
    return start, end


def mid_season(year: Column, season: Column) -> Column:
    """The middle day, the earlier of two; NULL for the season ``static``."""
    start, end = season_window(year, season)
    return F.when(F.lower(season) != "static", F.date_add(start, F.floor(F.datediff(end, start) / 2).cast("int")))


def in_season(date: Column, year: Column, season: Column) -> Column:
    start, end = season_window(year, season)
    return date.between(start, end)
