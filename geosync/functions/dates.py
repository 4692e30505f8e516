"""Dates written as text, years, zones, EXIF values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geosync.functions.text import strip_all

ZONE = "Europe/Moscow"


def parse_text_date(value: Column) -> Column:
    """ISO date or timestamp, ``DD.MM.YYYY`` or ``DD.MM.YY`` as a date; NULL for anything else.

    Two-digit years run from 1970 to 2069.
    """
    text = F.trim(value)
    century = F.when(F.substring(text, 7, 2) >= "70", F.lit("19")).otherwise(F.lit("20"))
    short = F.concat(F.substring(text, 1, 6), century, F.substring(text, 7, 2))
    return (
        F.when(
            text.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ]\d{2}:)"),
            F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"),
        )
        .when(text.rlike(r"^\d{2}\.\d{2}\.\d{4}$"), F.try_to_date(text, "dd.MM.yyyy"))
        .when(text.rlike(r"^\d{2}\.\d{2}\.\d{2}$"), F.try_to_date(short, "dd.MM.yyyy"))
    )


def extract_year(value: Column) -> Column:
    """First four digits in a row as an integer, else NULL."""
    return F.regexp_extract(value, r"(\d{4})", 1).try_cast("int")


def multi_format_date(value: Column) -> Column:
    """Text date in one of three notations, or a spreadsheet serial number."""
    text = strip_all(value)
    serial = F.when(text.rlike(r"^\d+(\.\d+)?$"), F.floor(text.try_cast("double")).cast("int"))
    # A sheet counts a 29 February 1900 that never was: serials below 60 lie a day later.
    shifted = F.when(serial < 60, serial + 1).otherwise(serial)
    return (
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))
        .when(text.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.try_to_date(text, "d.M.yyyy"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(text, "d/M/yyyy"))
        .when(serial >= 1, F.date_add(F.lit("1899-12-30").cast("date"), shifted))
    )


def exif_date(value: Column) -> Column:
    """Date part of ``YYYY:MM:DD HH:MM:SS`` or the same with hyphens."""
    text = strip_all(value)
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy:MM:dd HH:mm:ss")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
    ).cast("date")


def date_from_name(name: Column) -> Column:
    """First ``YYYY-MM-DD`` inside a file name."""
    return F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def today(at: Column, zone: str = ZONE) -> Column:
    """Calendar day of a UTC instant in ``zone``."""
    return F.from_utc_timestamp(at, zone).cast("date")


def rational(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def dms_to_decimal(degrees: Column, minutes: Column, seconds: Column, ref: Column) -> Column:
    """Degrees, minutes and seconds as signed decimal degrees; NULL without a hemisphere."""
    size = degrees + minutes / 60.0 + seconds / 3600.0
    side = F.upper(strip_all(ref))
    return F.when(side.isNull(), None).when(side.isin("S", "W"), -size).otherwise(size)


def coord_key(value: Column) -> Column:
    """Coordinate rounded to nine decimals, fit for a key."""
    return F.round(value, 9)
