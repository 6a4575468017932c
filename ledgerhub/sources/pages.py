"""Landed API pages: ``{"value": [...], "@odata.nextLink": ...}`` below ``Entity=<company>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerhub.functions.text import quoted
from ledgerhub.sizing import company_side

NEXT_LINK = "@odata.nextLink"
#: A record of which nothing is known: all its fields, each with the kind of value that landed.
RAW = T.VariantType()


def read_pages(
    spark: SparkSession, folder: str, record: T.StructType | T.VariantType, one_per_line: bool = True
) -> DataFrame:
    """Pages with company, page number and record array.

    One page per line keeps files splittable; one page per file is read whole. A page
    without ``page_no`` takes the last number of its file name. With records as :data:`RAW` pages are
    parsed once for all that is asked of them: :func:`records`, :func:`fields`.
    """
    schema = (
        T.StructType()
        .add("page_no", T.LongType())
        .add("value", T.ArrayType(record))
        .add(NEXT_LINK, T.StringType())
        .add("Entity", T.StringType())
    )
    numbered = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1).try_cast("bigint")
    return (
        spark.read.schema(schema)
        .option("multiLine", not one_per_line)
        .json(folder)
        .withColumn("page_no", F.coalesce("page_no", numbered))
    )


def _path(name: str) -> str:
    """The place of a field in a record, by its exact name."""
    if "'" in name and '"' in name:
        raise ValueError(f"a field name with both kinds of quotes can't be read: {name}")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def records(pages: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """One row per record, with its place in the pull.

    Of :data:`RAW` records the fields of ``schema`` are taken, by exact name; a value that doesn't fit is NULL.
    """
    each = pages.select("Entity", "page_no", F.posexplode("value").alias("pos", "record"))
    if schema is None:
        return each.select("Entity", "page_no", "pos", "record.*")
    typed = [F.try_variant_get("record", _path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return each.select("Entity", "page_no", "pos", *typed)


def fields(pages: DataFrame) -> DataFrame:
    """(column, value) of each field of :data:`RAW` records, a landed null included."""
    each = pages.select(F.explode("value").alias("record"))
    found = each.lateralJoin(each.sparkSession.tvf.variant_explode(F.col("record").outer()))
    return found.select(F.col("key").alias("column"), "value")


def chain_status(pages: DataFrame) -> DataFrame:
    """Per company: is the page chain whole?

    Only the last page may lack a next link or be empty; pages count up from 0 or 1 without
    gaps. A page without a record list, such as a damaged one, never ends a chain.
    """
    empty = F.size("value") == 0
    ends = F.col("value").isNotNull() & (F.col(f"`{NEXT_LINK}`").isNull() | empty)
    per_page = pages.select("Entity", "page_no", ends.alias("ends"))
    facts = per_page.groupBy("Entity").agg(
        F.count(F.lit(1)).alias("pages"),
        F.min("page_no").alias("first_page"),
        F.max("page_no").alias("last_page"),
        F.max_by("ends", "page_no").alias("ended"),
        F.count_if("ends").alias("end_pages"),
    )
    whole = (
        F.col("ended")
        & (F.col("end_pages") == 1)
        & F.col("first_page").isin(0, 1)
        & (F.col("last_page") - F.col("first_page") + 1 == F.col("pages"))
    )
    return facts.select("Entity", "pages", F.coalesce(whole, F.lit(False)).alias("complete"))


def complete_pages(pages: DataFrame, status: DataFrame) -> DataFrame:
    """Pages of companies whose chain is whole; the others must not be applied."""
    good = company_side(status.where("complete").select("Entity"))
    return pages.join(good, "Entity", "left_semi").select(*quoted(pages.columns))


def incomplete_companies(status: DataFrame) -> DataFrame:
    return status.where(~F.col("complete")).select("Entity", "pages")


def field_counts(found: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """(column, filled, unfit) of each field name in :func:`fields`.

    ``filled`` is in how many records the field has a value, ``unfit`` how many of these are no value of the
    type that ``schema`` has under that exact name. Every value has a text.
    """
    by_type: dict[str, list[str]] = {}
    for f in schema.fields if schema else []:
        by_type.setdefault(f.dataType.simpleString(), []).append(f.name)
    fits = F.lit(True)
    by_type.pop("string", None)
    for kind, names in by_type.items():
        fits = F.when(F.col("column").isin(names), F.try_variant_get("value", "$", kind).isNotNull()).otherwise(fits)
    has = ~F.is_variant_null("value")
    return found.groupBy("column").agg(F.count_if(has).alias("filled"), F.count_if(has & ~fits).alias("unfit"))
