"""Row filters of the incremental loads. Dates are parameters, never the clock."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def _day(day: str | Column) -> Column:
    return F.lit(day).cast("date") if isinstance(day, str) else day


def modified_since(
    df: DataFrame, column: str, run_date: str | Column, days: int = 1
) -> DataFrame:
    """Rows changed after midnight ``days`` before the run date."""
    return df.where(F.col(column) > F.date_sub(_day(run_date), days))


def modified_after(df: DataFrame, column: str, bound: str) -> DataFrame:
    """Rows changed after a fixed bound."""
    return df.where(F.col(column) > F.lit(bound).cast(df.schema[column].dataType))


def created_on(column: Column, run_date: str | Column) -> Column:
    """Created during the run date."""
    return F.to_date(column) == _day(run_date)


def of_kinds(df: DataFrame, column: str, kinds: Iterable) -> DataFrame:
    """Rows of one of the kinds."""
    return df.where(F.col(column).isin(list(kinds)))


def older_than(column: Column, now: Column, minutes: int) -> Column:
    """Received more than ``minutes`` before ``now``."""
    return column < now - F.make_dt_interval(mins=F.lit(minutes))
