"""Landed answers of the count endpoint, one small text per company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerhub.functions.text import first_number


def counted(answer: Column) -> Column:
    """Number in a count answer; byte order mark and blanks do not matter, no digits is NULL."""
    return first_number(answer)


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Company and count; NULL where the answer was an error text."""
    answers = spark.read.schema("value STRING, Entity STRING").text(folder, wholetext=True)
    return answers.select("Entity", counted(F.col("value")).alias("source_rows"))
