"""Date and time expressions. The clock is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerhub.fixed_values import FIRST_REAL_DATE


def at_time(day: Column, time_of_day: Column) -> Column:
    """Date plus time of day; a missing time is midnight, a missing date is NULL."""
    clock = F.coalesce(time_of_day, F.lit("00:00:00"))
    return F.try_to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), clock))


def real_time(day: Column, time_of_day: Column) -> Column:
    """``at_time``, with placeholder dates before 1900 as NULL."""
    return F.when(day >= F.lit(FIRST_REAL_DATE).cast("date"), at_time(day, time_of_day))


def strict_date(text: Column) -> Column:
    """Year-month-day text as DATE; NULL where it does not parse."""
    shaped = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text)
    return F.try_to_date(shaped, "yyyy-M-d")


def minute_stamp_day(text: Column) -> Column:
    """Day of a ``yyyy-MM-dd HH:mm`` text; empty text where it does not parse."""
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit(""))


def day_text(moment: Column) -> Column:
    """Day as text; empty text for NULL."""
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd"), F.lit(""))


def iso_day(text: Column) -> Column:
    """Text before the ``T`` of an ISO timestamp."""
    return F.split_part(text, F.lit("T"), F.lit(1))


def whole_minutes(start: Column, end: Column) -> Column:
    """Elapsed minutes, cut off."""
    return F.timestamp_diff("MINUTE", start, end).cast("int")


def days_before(day: Column, days: int) -> Column:
    return F.date_sub(day, days)
