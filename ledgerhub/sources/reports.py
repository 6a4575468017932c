"""CSV reports and mapping lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerhub.fixed_values import VOYAGE_DATA_TYPE, VOYAGE_SNAPSHOT


def positional_schema(n_columns: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i + 1}", T.StringType()) for i in range(n_columns)])


def positional_report(
    spark: SparkSession, path: str, n_columns: int, quoted_newlines: bool = False
) -> DataFrame:
    """Report read by position as text, header skipped. A row of another width fails the read."""
    return (
        spark.read.schema(positional_schema(n_columns))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", quoted_newlines)
        .csv(path)
    )


def named_report(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Report read by header names as text; bind it to a schema afterwards."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("sep", separator)
        .option("escape", '"')
        .csv(path)
    )


def settled_voyages(report: DataFrame) -> DataFrame:
    return report.where(
        (F.col("DataType") == VOYAGE_DATA_TYPE) & (F.col("SnapShotType") == VOYAGE_SNAPSHOT)
    )


def mapping_keys(report: DataFrame, column: str) -> DataFrame:
    """The one column of a mapping list that is used, as text."""
    return report.select(F.col(column).cast("string").alias(column))
