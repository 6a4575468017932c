"""Accounts that the mapping list does not know."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ledgerhub.functions.text import no_trailing_blanks
from ledgerhub.operators.presence import absent


def missing_accounts(
    accounts: DataFrame,
    mapping: DataFrame,
    key: str = "no",
    excluded: Iterable[str] = (),
) -> DataFrame:
    """Distinct account numbers, as text, that are not in the mapping's ``key`` column.

    Companies in ``excluded`` do not count; trailing blanks of their names do not matter.
    """
    excluded = [name.rstrip(" ") for name in excluded]
    kept = accounts
    if excluded:
        kept = accounts.where(~no_trailing_blanks(F.col("Entity")).isin(excluded))
    numbers = kept.select(F.col("no").cast("string").alias("no")).distinct()
    known = mapping.select(F.col(key).cast("string").alias("no"))
    return absent(numbers, known, ["no"])


def missing_message(missing: DataFrame) -> DataFrame:
    """A row for each missing number, and one without number that has their total.

    Joining the numbers to one text is mail delivery. Without missing numbers there is no row.
    """
    total = missing.agg(F.count(F.lit(1)).alias("total_missing")).where("total_missing > 0")
    each = missing.select(
        "no", F.lit(None).cast("long").alias("total_missing"),
        F.concat(F.lit("Value missing in Excel: "), "no").alias("error_details"),
    )
    return each.unionByName(total.select(
        F.lit(None).cast("string").alias("no"), "total_missing",
        F.format_string("Values missing in Excel: %d", "total_missing").alias("error_details"),
    ))
