"""Small Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def leading_int(text: Column) -> Column:
    """The integer a text starts with (``'35 mins'`` -> 35), else null."""
    return F.regexp_extract(text, r"^\s*(\d+)", 1).try_cast("int")


def minutes_before_space(text: Column) -> Column:
    """Compatibility reading of a duration: digits before the first space, else 0."""
    return F.coalesce(F.regexp_extract(text, r"^(\d+)[^ ]* ", 1).try_cast("int"), F.lit(0))


def packed(*texts: Column) -> Column:
    """Texts as one, which sorts as they do one after the other, nulls first. Each ends at a zero
    character, and begins with a one unless it is null."""
    def field(text: Column) -> Column:
        plain = F.replace(F.replace(text, F.lit("\1"), F.lit("\1\3")), F.lit("\0"), F.lit("\1\2"))
        return F.coalesce(F.concat(F.lit("\1"), plain, F.lit("\0")), F.lit("\0"))

    return F.concat(*map(field, texts))


def unpacked(text: Column, at: int) -> Column:
    """One of :func:`packed` texts."""
    field = F.split(text, "\0")[at]
    held = F.substring(field, 2, 2**31 - 1)
    plain = F.replace(F.replace(held, F.lit("\1\2"), F.lit("\0")), F.lit("\1\3"), F.lit("\1"))
    return F.when(field != "", plain)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded; null when ``whole`` is 0 or null."""
    return F.round(F.lit(100.0) * part / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def whole_weeks(days: Column) -> Column:
    """Days to whole weeks, truncated toward zero."""
    return (days / F.lit(7)).cast("int")


def at_least(value: Column, floor: int) -> Column:
    """``max(value, floor)`` that stays null for a null value (``greatest`` would not)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def count_where(condition: Column) -> Column:
    """Rows meeting a condition; 0 (never null) when there are none."""
    return F.count(F.when(condition, F.lit(1)))


def exact_mean(value: Column, digits: int, scale: int = 2) -> Column:
    """Rounded mean of values that have ``scale`` decimals, summed as decimals: the result
    does not depend on the order in which partitions are added up."""
    return F.round(F.avg(value.cast(f"decimal(18,{scale})")), digits).cast("double")
