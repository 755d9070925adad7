"""Calendar-week arithmetic as Column expressions (no session time zone involved)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_WEEK_TEXT = r"^(\d{1,4})-W(\d{1,2})$"


def as_date(value: Column | date | str) -> Column:
    """A date column from a Column, a ``date`` or an ISO string."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` text as a date; anything else is null."""
    return F.try_to_date(text, "yyyy-M-d")


def week_start(day: Column) -> Column:
    """The Monday of the week holding ``day``."""
    return F.date_sub(day, F.weekday(day))


def week_end(day: Column) -> Column:
    """The Sunday of the week holding ``day``."""
    return F.date_add(week_start(day), 6)


def next_week_start(day: Column) -> Column:
    """The Monday after ``day``, never ``day`` itself."""
    return F.date_add(week_start(day), 7)


def iso_week_monday(year: Column, week: Column) -> Column:
    """Monday of an ISO week. Week numbers are not range-checked, so 0 and 53 just compute."""
    january_4 = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(week_start(january_4), (week - F.lit(1)) * F.lit(7))


def week_window(selector: Column) -> Column:
    """``struct<start, end>`` (Monday, Sunday) of ``YYYY-Www`` or ``YYYY-MM-DD`` text.

    Null gives null bounds, unreadable text is an error: a filter on such bounds would silently
    select nothing.
    """
    year, week = (F.regexp_extract(selector, ISO_WEEK_TEXT, group).try_cast("int")
                  for group in (1, 2))
    monday = F.coalesce(iso_week_monday(year, week), week_start(iso_date(selector)))
    monday = F.when(monday.isNotNull() | selector.isNull(), monday).otherwise(
        F.raise_error(F.concat(F.lit("not a week or date: "), selector)).cast("date"))
    return F.struct(monday.alias("start"), F.date_add(monday, 6).alias("end"))


def date_window(start: Column, end: Column) -> Column:
    """``struct<start, end>`` of two ISO texts; fails on unreadable or reversed bounds."""
    first, last = iso_date(start), iso_date(end)
    ordered = first.isNotNull() & last.isNotNull() & (first <= last)
    return F.when(ordered, F.struct(first.alias("start"), last.alias("end"))).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("not a date range:"), start, end)))
