"""Row counts per company and their comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def rows_per_company(
    df: DataFrame,
    entity: str = "Entity",
    name: str = "rows",
    conditions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows per company, and how many of them meet each named condition, in one pass."""
    met = [F.count_if(condition).alias(n) for n, condition in (conditions or {}).items()]
    return df.groupBy(entity).agg(F.count(F.lit(1)).alias(name), *met)


def compared_counts(
    names: DataFrame, source_counts: DataFrame, table: DataFrame, entity: str = "Entity"
) -> DataFrame:
    """Source and table counts of every registered company.

    ``source_counts`` holds one ``source_rows`` per company, ``table`` the rows to count. A
    count answer that is NULL gives status ``unknown``: an error text is no mismatch. A
    company that neither side knows has zero rows. All three inputs meet in one aggregate,
    so the table's rows are counted in the map tasks and there is a single exchange.
    """
    def part(df: DataFrame, kind: str, source=None) -> DataFrame:
        return df.select(
            entity, F.lit(kind).alias("kind"),
            (F.lit(None) if source is None else F.col(source)).cast("bigint").alias("source"),
        )

    registered = names.select(F.col("name").alias(entity))
    parts = (
        part(registered, "company")
        .unionByName(part(source_counts, "answer", "source_rows"))
        .unionByName(part(table, "row"))
    )
    grouped = parts.groupBy(entity).agg(
        F.count_if(F.col("kind") == "company").alias("registered"),
        F.count_if(F.col("kind") == "answer").alias("answers"),
        F.max("source").alias("answer"),
        F.count_if(F.col("kind") == "row").alias("table_rows"),
    )
    source = F.when(F.col("answers") > 0, F.col("answer")).otherwise(F.lit(0))
    table_rows = F.col("table_rows")
    status = (
        F.when(source.isNull(), "unknown")
        .when(source == table_rows, "equal")
        .otherwise("mismatch")
    )
    return grouped.where("registered > 0").select(
        entity,
        source.alias("source_rows"),
        "table_rows",
        F.abs(source - table_rows).alias("difference"),
        status.alias("status"),
    )
