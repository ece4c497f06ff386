"""Dates as the exchange writes and reads them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from tidemark.functions.text import strip
from tidemark.schema import IMPORT_DATE_FORMAT

# The shapes of an accepted date.  There is no year 0000.
ISO_DAY = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$"
COMPACT_DAY = r"^(?!0000)[0-9]{8}$"
SLASH_DAY = r"^[0-9]{1,2}/([0-9]{1,2}| [1-9])/(?!0000)[0-9]{4}$"
ISO_WEEK = r"^([0-9]{4})(-?)W([0-9]{2})(?:\2([1-7]))?$"
FILE_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def _week_day(text: Column) -> Column:
    """A date written as ISO year, week and optional day of the week."""
    year = F.regexp_extract(text, ISO_WEEK, 1).cast("int")
    week = F.regexp_extract(text, ISO_WEEK, 3).cast("int")
    day_text = F.regexp_extract(text, ISO_WEEK, 4)
    day = F.when(day_text == "", F.lit(1)).otherwise(day_text.try_cast("int"))
    fourth = F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))
    first_monday = F.date_sub(fourth, F.weekday(fourth))
    monday = F.date_add(first_monday, (week - 1) * 7)
    real = (year > 0) & (week > 0) & (F.weekofyear(monday) == week)
    return F.when(real, F.date_add(monday, day - 1))


def flexible_date(column: Column) -> Column:
    """ISO forms first, then month/day/year; null when neither fits.

    The patterns guard each parse, so a value that only begins like a date, or
    carries a time, is refused rather than cut down to a day.
    """
    text = strip(column)
    slashed = F.replace(text, F.lit(" "), F.lit(""))
    return (
        F.when(text.rlike(ISO_DAY), F.try_to_date(text, "yyyy-MM-dd"))
        .when(text.rlike(SLASH_DAY), F.try_to_date(slashed, "M/d/yyyy"))
        .when(text.rlike(COMPACT_DAY), F.try_to_date(text, "yyyyMMdd"))
        .when(text.rlike(ISO_WEEK), _aside(text, _week_day))
    )


def _aside(column: Column, function: Callable[[Column], Column]) -> Column:
    """A rare branch, kept out of the generated code of the common ones so
    that their method stays small enough for the JVM to compile."""
    return F.element_at(F.transform(F.array(column), function), 1)


def import_date(column: Column) -> Column:
    return F.date_format(column, IMPORT_DATE_FORMAT)


def period(column: Column, pattern: str = "yyyy-MM") -> Column:
    """The submission period a day belongs to."""
    return F.date_format(column, pattern)


def file_age(file_name: Column, as_of: Column) -> Column:
    """Days since the date a file name begins with; null if it has none."""
    head = F.substring(file_name, 1, 10)
    day = F.when(head.rlike(FILE_DAY), F.try_to_date(head, "yyyy-M-d"))
    return F.datediff(as_of, day)


def month_window(as_of: dt.date, months: int = 2) -> list[tuple[int, int]]:
    """The month of ``as_of`` and those before it, newest first."""
    count = as_of.year * 12 + as_of.month - 1
    return [((count - back) // 12, (count - back) % 12 + 1) for back in range(months)]
