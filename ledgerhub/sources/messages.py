"""Files with many XML messages, split by element.

The XML source reads a file as one document: behind the first element that isn't well-formed the rest of the
file is lost. Here the end tag separates records of the text source, which cuts large files into splits; each
element is parsed by itself, so a damaged one costs no other.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerhub.functions.text import quoted

CORRUPT = "_corrupt_record"


def elements(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(payload) of each element ``tag``: from a start tag to the next end tag.

    A start tag without an end tag before the next one is a row of its own, up to there. What lies outside, such as
    an outer element or a declaration, is left out. Elements of this name don't hold others of it. A file that
    breaks off inside its last element can't be told from one that ends with it: where it breaks off between
    two fields, only a schema document (``read_xml``) shows that the later ones are missing.
    """
    end = f"</{tag}>"
    text = spark.read.option("lineSep", end).text(path)
    begin = rf"(?=<{re.escape(tag)}[\s>/])"
    parts = F.split("value", begin)
    # of the pieces of a record only the last one met the end tag
    numbered = text.select(F.posexplode(parts).alias("place", "piece"), F.size(parts).alias("pieces"))
    met = F.col("place") == F.col("pieces") - 1
    started = numbered.where(F.col("piece").startswith(f"<{tag}"))
    return started.select(F.when(met, F.concat("piece", F.lit(end))).otherwise(F.rtrim("piece")).alias("payload"))


def read_xml(spark: SparkSession, path: str, tag: str, schema: T.StructType, xsd: str | None = None) -> DataFrame:
    """A row per element ``tag`` of the files, with the columns of ``schema`` and ``_corrupt_record``.

    An element that is not well-formed, holds a value that is not of its column's type, or does not meet the
    schema document ``xsd`` keeps its text in ``_corrupt_record``. ``xsd`` is a path that executors can read.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "rowTag": tag}
    if xsd:
        options["rowValidationXSDPath"] = xsd
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_xml("payload", fields, options).alias("message")
    lost: Column = F.coalesce(F.col(f"message.{CORRUPT}"), F.when(F.col("message").isNull(), F.col("payload")))
    return elements(spark, path, tag).select("payload", parsed).select(
        *[F.col(f"message.{c}").alias(n) for c, n in zip(quoted(schema.names), schema.names)], lost.alias(CORRUPT))


def good_and_bad(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole messages, and the text of the others."""
    names = [c for c in read.columns if c != CORRUPT]
    bad = F.col(CORRUPT).isNotNull()
    return read.where(~bad).select(*quoted(names)), read.where(bad).select(F.col(CORRUPT).alias("payload"))
