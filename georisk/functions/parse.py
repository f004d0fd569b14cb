"""Scalar parsing expressions (all JVM-side column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import ROAD_TYPE_CODES, ROAD_TYPE_DEFAULT, SPEED_DEFAULT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_decimal_comma(c) -> Column:
    """' -22,5' -> -22.5 ; junk -> NULL (ANSI-safe)."""
    return F.regexp_replace(F.trim(_c(c).cast("string")), ",", ".").try_cast("double")


def clean_hrmn(hrmn, mode: str = "correct") -> Column:
    """Normalise the HHMM text to 'HH:MM'.

    correct: drop ':' then left-pad to 4 digits ('14:30'->'14:30', '930'->'09:30').
    compat : left-pad the raw text to 4 characters and cut HH / MM, so
             '14:30' becomes '14' + ':3' -> minutes '3' (the known defect).
    """
    s = _c(hrmn).cast("string")
    if mode == "correct":
        digits = F.lpad(F.regexp_replace(F.trim(s), ":", ""), 4, "0")
        return F.concat(F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2))
    if mode == "compat":
        padded = F.lpad(s, 4, "0")
        return F.concat(F.substring(padded, 1, 2), F.lit(":"), F.substring(padded, 3, 2))
    raise ValueError(f"unknown hrmn mode {mode!r}")


def assemble_datetime(jour, mois, an, hrmn, mode: str = "correct") -> Column:
    """dd/MM/yyyy HH:MM:00 built from parts, parsed leniently, NULL on failure.

    In compat mode the doubled ':' produced by the cut is collapsed once
    (first occurrence only), then the lenient pattern accepts one-digit fields.
    """
    text = F.concat(
        F.lpad(_c(jour).cast("string"), 2, "0"), F.lit("/"),
        F.lpad(_c(mois).cast("string"), 2, "0"), F.lit("/"),
        _c(an).cast("string"), F.lit(" "),
        clean_hrmn(hrmn, mode), F.lit(":00"),
    )
    text = F.regexp_replace(text, r"^(.*?)::", "$1:")
    return F.try_to_timestamp(text, F.lit("d/M/yyyy H:m:s")).cast("timestamp_ntz")


def try_assemble_datetime(jour, mois, an, hrmn) -> Column:
    """Raw hrmn appended (expects 'HH:MM:SS'); NULL when it does not parse."""
    text = F.concat(
        F.lpad(_c(jour).cast("string"), 2, "0"), F.lit("/"),
        F.lpad(_c(mois).cast("string"), 2, "0"), F.lit("/"),
        _c(an).cast("string"), F.lit(" "), _c(hrmn).cast("string"),
    )
    return F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm:ss")).cast("timestamp_ntz")


def day_of_week(ts, base: str = "mon0") -> Column:
    """Three codings: 'mon0' Mon=0..Sun=6, 'iso' Mon=1..Sun=7, 'sun0' Sun=0..Sat=6."""
    t = _c(ts)
    if base == "mon0":
        return F.weekday(t).cast("int")
    if base == "iso":
        return (F.weekday(t) + 1).cast("int")
    if base == "sun0":
        return (F.dayofweek(t) - 1).cast("int")
    raise ValueError(f"unknown dow base {base!r}")


def parse_speed(c, default: int = SPEED_DEFAULT) -> Column:
    """First whitespace-separated word if it is all digits, else the default."""
    first = F.regexp_extract(F.coalesce(_c(c).cast("string"), F.lit("")), r"^\s*(\S+)", 1)
    num = F.when(first.rlike(r"^[0-9]+$"), first.try_cast("int"))
    return F.coalesce(num, F.lit(default)).cast("int")


def first_of_list(c) -> Column:
    """List-or-scalar -> first element text (NULL for an empty list)."""
    return F.try_element_at(_c(c), F.lit(1))


def road_type_code(highway_text, codes: dict | None = None, default: int = ROAD_TYPE_DEFAULT) -> Column:
    """Road class text -> code via a literal map; unknown or NULL -> default."""
    codes = codes or ROAD_TYPE_CODES
    m = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, F.coalesce(_c(highway_text), F.lit("unclassified"))),
                      F.lit(default)).cast("int")


def map_lookup(c, mapping: dict, default) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, _c(c)), F.lit(default))
