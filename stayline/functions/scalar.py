"""Dates, numbers and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_TEXT = "dd-MM-yyyy"


def parse_date(text: Column) -> Column:
    """``dd-MM-yyyy`` text to DATE, NULL where it does not parse."""
    return F.try_to_date(text, DATE_TEXT)


def format_date(day: Column) -> Column:
    """DATE to ``dd-MM-yyyy`` text, '' for a missing date."""
    return F.coalesce(F.date_format(day, DATE_TEXT), F.lit(""))


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def safe_number(value: Column) -> Column:
    """A number from text, 0 where it does not parse."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def round_half_up(value: Column, digits: int) -> Column:
    """Round ties towards positive infinity (-2.5 -> -2), unlike ``F.round``."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def fixed_decimals(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", value)


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def floor_div(value: Column, step: int) -> Column:
    return F.floor(value / F.lit(step)).cast("int")


def prefixed_id(prefix: str, number: Column, width: int = 12) -> Column:
    """``CUST`` + zero padded number. A longer number is kept in full, never cut."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage rounded to ``digits``, 0 where the whole is 0."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole), digits), F.lit(0.0))


def floor_percent(part: Column, whole: Column) -> Column:
    """Whole percent, rounded down, NULL where the whole is 0."""
    return F.floor(F.try_divide(part * F.lit(100), whole)).cast("bigint")
