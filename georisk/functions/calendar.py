"""Calendar flags and cyclic encodings as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import HOLIDAYS, SCHOOL_HOLIDAY_MONTHS, CalendarProfile


def _c(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def flag(cond: Column) -> Column:
    return cond.cast("int")


def is_weekend(dow, profile: CalendarProfile) -> Column:
    return flag(_c(dow) >= profile.weekend_from)


def is_rush_morning(hour, profile: CalendarProfile) -> Column:
    lo, hi = profile.rush_morning
    return flag(_c(hour).between(lo, hi))


def is_rush_evening(hour, profile: CalendarProfile) -> Column:
    lo, hi = profile.rush_evening
    return flag(_c(hour).between(lo, hi))


def is_night(hour, profile: CalendarProfile) -> Column:
    h = _c(hour)
    return flag((h >= profile.night_from) | (h <= profile.night_to))


def is_holiday(month, day) -> Column:
    """(month, day) membership in the fixed holiday list."""
    code = _c(month) * 100 + _c(day)
    return flag(code.isin([m * 100 + d for m, d in HOLIDAYS]))


def school_holidays(month) -> Column:
    return flag(_c(month).isin(list(SCHOOL_HOLIDAY_MONTHS)))


def cyclic(v, period: int) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*v/period; 2*pi*v is formed first, then divided (same rounding as the SQL form)."""
    ang = F.lit(2 * math.pi) * _c(v) / F.lit(period)
    return F.sin(ang), F.cos(ang)
