"""Lenient text-to-value conversions; anything unreadable becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(text: Column) -> Column:
    plain = F.trim(text)
    return F.coalesce(plain.try_cast("long"), plain.try_cast("double").try_cast("long"))


def safe_float(text: Column) -> Column:
    """Number out of text such as "$1,000,000"; empty and "N/A" are null."""
    return F.trim(F.regexp_replace(text, "[,$]", "")).try_cast("double")


# What the letter after a number of money multiplies it by.
SCALE = {"m": 1e6, "b": 1e9}


def money(text: Column) -> Column:
    """ "$11M", "10 Million", "1.2B" to an amount: the first number, scaled by the letter that follows it."""
    bare = F.translate(text, "$,", "")
    number = F.regexp_substr(bare, F.lit(r"[0-9.]+")).try_cast("double")
    letter = F.lower(F.regexp_extract(bare, r"[0-9.]\s*(\p{L})", 1))
    scale = F.create_map(*[F.lit(x) for pair in SCALE.items() for x in pair])
    return number * F.coalesce(scale[letter], F.lit(1.0))


def date_before_time(text: Column) -> Column:
    """Calendar date in front of the `T` of an ISO timestamp."""
    return F.try_to_date(F.get(F.split(text, "T"), F.lit(0)), "yyyy-MM-dd")


def page_date(text: Column, year: Column) -> Column:
    """"December 28, 2024", or month and day completed by the page's year; full or short month names."""
    with_year = F.concat_ws(" ", text, year.cast("string"))
    return F.coalesce(
        F.try_to_date(text, "MMMM d, yyyy"),
        F.try_to_date(text, "MMM d, yyyy"),
        F.try_to_date(with_year, "MMMM d yyyy"),
        F.try_to_date(with_year, "MMM d yyyy"),
    )
