"""Tables of this and of other databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A registered table, of another database or catalog if one is named."""
    return spark.table(f"{database}.{name}" if database else name)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower: int,
    upper: int,
    parts: int,
    **options: str,
) -> DataFrame:
    """A table or query of a live database, read in ``parts`` ranges at once.

    Needs the database's JDBC driver on the class path. The bounds only place the ranges;
    rows outside of them are read too.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=split_column, **options)
        .options(lowerBound=lower, upperBound=upper, numPartitions=parts)
        .load()
    )
