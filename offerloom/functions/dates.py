"""Date and ISO week functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """The date in the first ten characters; null where there is none."""
    return F.try_to_timestamp(F.left(c, F.lit(10)), F.lit("yyyy-MM-dd")).cast("date")


def parse_date_any(c: Column) -> Column:
    """A date written yyyy-MM-dd HH:mm, yyyy-MM-dd, dd.MM.yyyy or yyyyMMdd."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in ("yyyy-MM-dd HH:mm", "yyyy-MM-dd", "dd.MM.yyyy", "yyyyMMdd")]).cast("date")


def week_exists(year: Column, week: Column) -> Column:
    return (week >= 1) & (week <= F.weekofyear(F.make_date(year, F.lit(12), F.lit(28))))


def week_start(year: Column, week: Column) -> Column:
    """Monday of an ISO week; null where the year has no such week."""
    monday = F.date_add(F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week"), ((week - 1) * 7).cast("int"))
    return F.when(week_exists(year, week), monday)


def week_label(year: Column, week: Column) -> Column:
    return F.when(year.isNotNull() & week.isNotNull(), F.format_string("KW%02d_%d", week, year))


def valid_through_friday(valid_to: Column, year: Column, week: Column) -> Column:
    """Whether an offer holds through the Friday of its ISO week; false where anything is missing."""
    return F.coalesce(valid_to >= F.date_add(week_start(year, week), 4), F.lit(False))


def short_range(start: Column, end: Column) -> Column:
    """'dd.MM.-dd.MM.' of what is there."""
    return F.concat_ws("-", F.date_format(start, "dd.MM."), F.date_format(end, "dd.MM."))


def overlaps(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Whether [start, end] meets [first, last]; true where start or end is missing."""
    return start.isNull() | end.isNull() | ((start <= last) & (end >= first))


def freshness(day: Column, today: Column) -> Column:
    """How old a day is: 'week', 'month' or 'year' back from today, 'older', 'future'; null for null."""
    age = F.datediff(today, day)
    return F.when(age < 0, "future").when(age <= 7, "week").when(age <= 31, "month").when(age <= 365, "year").when(age.isNotNull(), "older")
