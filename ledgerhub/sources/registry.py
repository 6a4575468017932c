"""Company registry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerhub.functions.text import no_trailing_blanks, quoted
from ledgerhub.sizing import company_side


def company_names(
    registry: DataFrame, skip: Iterable[str] = (), ignore_trailing_blanks: bool = False
) -> DataFrame:
    """Registered names as text, less those to skip."""
    names = registry.select(F.col("name").cast("string").alias("name"))
    skip = list(skip)
    if not skip:
        return names
    if ignore_trailing_blanks:
        skipped = no_trailing_blanks(F.col("name")).isin([s.rstrip(" ") for s in skip])
    else:
        skipped = F.col("name").isin(skip)
    return names.where(~skipped)


def read_companies(spark: SparkSession, table: str = "companies", **options) -> DataFrame:
    """Names from a registry table; there may be more than one such table."""
    return company_names(spark.table(table), **options)


def for_companies(df: DataFrame, names: DataFrame, entity: str = "Entity") -> DataFrame:
    """Rows of registered companies: one scan instead of one pull per company."""
    wanted = company_side(names.select(F.col("name").alias(entity)).distinct())
    return df.join(wanted, entity, "left_semi").select(*quoted(df.columns))
