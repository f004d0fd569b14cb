"""Conditional bands and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import MARKER_BAND_LOW, MARKER_BANDS, RISK_LEVEL_TOP, RISK_LEVELS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def risk_level(p) -> Column:
    """LOW < 0.2 <= MEDIUM < 0.5 <= HIGH < 0.8 <= CRITICAL."""
    p = _c(p)
    expr = None
    for bound, name in RISK_LEVELS:
        expr = F.when(p < bound, F.lit(name)) if expr is None else expr.when(p < bound, F.lit(name))
    return expr.otherwise(F.lit(RISK_LEVEL_TOP))


def confidence(p) -> Column:
    p = _c(p)
    return F.greatest(p, F.lit(1.0) - p)


def marker_colour(p) -> Column:
    p = _c(p)
    expr = None
    for bound, colour, _ in MARKER_BANDS:
        expr = F.when(p >= bound, F.lit(colour)) if expr is None else expr.when(p >= bound, F.lit(colour))
    return expr.otherwise(F.lit(MARKER_BAND_LOW[0]))


def marker_level(p) -> Column:
    p = _c(p)
    expr = None
    for bound, _, label in MARKER_BANDS:
        expr = F.when(p >= bound, F.lit(label)) if expr is None else expr.when(p >= bound, F.lit(label))
    return expr.otherwise(F.lit(MARKER_BAND_LOW[1]))


def hour_label(hour) -> Column:
    """'%02dh00'."""
    return F.format_string("%02dh00", _c(hour).cast("int"))


def hour_short_label(hour) -> Column:
    """'%02dh'."""
    return F.format_string("%02dh", _c(hour).cast("int"))


def percent_label(p, decimals: int = 1) -> Column:
    """'12.5%' with half-even rounding of the percentage (as Python's format)."""
    return F.format_string(f"%.{decimals}f%%", F.bround(_c(p) * 100, decimals))


def position_label(lat, lon) -> Column:
    """'-22.2758, 166.4580': four decimals, half to even."""
    return F.format_string("%.4f, %.4f", F.bround(_c(lat), 4), F.bround(_c(lon), 4))


def date_label(date) -> Column:
    """'2026-01-23 (Friday)'."""
    d = _c(date)
    return F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" ("), day_name(d), F.lit(")"))


def day_name(date) -> Column:
    """English name of the day of week, whatever the locale."""
    return F.date_format(_c(date), "EEEE")


def month_name(date) -> Column:
    """English name of the month."""
    return F.date_format(_c(date), "MMMM")
