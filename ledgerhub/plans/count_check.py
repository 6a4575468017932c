"""Row-count reconciliation per company, holes in entry numbers, and the repairs they guide."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.operators import intervals
from ledgerhub.operators.counts import compared_counts
from ledgerhub.operators.watermark import above_watermark
from ledgerhub.scratch import written_once
from ledgerhub.sizing import company_side


def count_check(
    names: DataFrame, source_counts: DataFrame, table: DataFrame, entity: str = "Entity"
) -> DataFrame:
    """Every company with both counts and a status; see ``compared_counts``."""
    return compared_counts(names, source_counts, table, entity)


def mismatches(checked: DataFrame, entity: str = "Entity") -> DataFrame:
    """Companies whose counts differ, with the message of the run log."""
    return checked.where("status = 'mismatch'").select(
        entity,
        "source_rows",
        "table_rows",
        "difference",
        F.format_string(
            "Mismatch in row count for %s: API rows %d, SQL rows %d",
            F.col(entity), "source_rows", "table_rows",
        ).alias("error_details"),
    )


def check_totals(checked: DataFrame) -> DataFrame:
    """Number of companies per status and rows by which they differ."""
    return checked.groupBy("status").agg(
        F.count(F.lit(1)).alias("companies"),
        F.coalesce(F.sum("difference"), F.lit(0)).alias("rows_apart"),
    )


def repair_rows(
    names: DataFrame,
    source_counts: DataFrame,
    source: DataFrame,
    table: DataFrame,
    entry_no: str,
    entity: str = "Entity",
) -> DataFrame:
    """Rows to append: above the watermark, only for companies whose counts differ.

    Holes below a watermark stay; :func:`hole_rows` heals those.
    """
    checked = count_check(names, source_counts, table, entity)
    broken = company_side(checked.where("status = 'mismatch'").select(entity))
    wanted = source.join(broken, entity, "left_semi").select(*quoted(source.columns))
    return above_watermark(wanted, table, entry_no, entity)


def entry_gaps(table: DataFrame, entry_no: str, entity: str = "Entity", width: int = intervals.WIDTH) -> DataFrame:
    """Per company the ranges of entry numbers that its table skips, first and last included."""
    missing = intervals.gaps(intervals.of_numbers(table, entry_no, [entity], width), [entity], width)
    return _as_ranges(missing, entity)


def missing_ranges(
    source: DataFrame, table: DataFrame, entry_no: str, entity: str = "Entity", width: int = intervals.WIDTH
) -> DataFrame:
    """Per company the ranges of entry numbers that the source has and the table hasn't."""
    return _as_ranges(_missing(source, table, entry_no, entity, width), entity)


def hole_rows(
    source: DataFrame, table: DataFrame, entry_no: str, entity: str = "Entity", width: int = intervals.WIDTH
) -> DataFrame:
    """Rows to append so that the table has every entry number of the source, below and above its watermark.

    Exactly the missing ranges are loaded; rows of a number that the table has are not compared
    (see ``plans/digest_check.py``). Several rows with a missing number are all loaded.
    """
    ranges = written_once(_missing(source, table, entry_no, entity, width), "ranges")
    return intervals.covered(source, entry_no, ranges, [entity], width)


def _missing(source: DataFrame, table: DataFrame, entry_no: str, entity: str, width: int) -> DataFrame:
    held = [intervals.of_numbers(df, entry_no, [entity], width) for df in (source, table)]
    return intervals.without(*held, [entity], width)


def _as_ranges(found: DataFrame, entity: str) -> DataFrame:
    return found.select(
        *quoted([entity]), F.col("lo").alias("first_no"), (F.col("hi") - 1).alias("last_no"),
        (F.col("hi") - F.col("lo")).alias("missing"))
