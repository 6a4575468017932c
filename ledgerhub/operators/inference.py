"""Columns of records that nobody declared, found from the values that landed.

What is known of a column is a handful of counts and maxima: how many of its values are of each
kind, and how many digits they have. Such facts add up, whatever the order, so they are a distributed
aggregate with sums in the map tasks, and those of two pulls are merged without reading either again.
The type is the least one that holds all values: flag, whole number, decimal, floating number, day or
time, and text above all. A flag and a number, or a number and a day, have only text in common.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerhub.functions.text import plain_name

COUNTS = ["records", "filled", "flags", "wholes", "decimals", "floats", "days", "times"]
SIZES = ["digits", "scale"]
MAX_COLUMNS = 5000
#: Decimals have at least this precision and scale, so that later amounts fit.
AMOUNT_DIGITS, AMOUNT_SCALE = 18, 2

_DAY = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?$"


def profile(fields: DataFrame) -> DataFrame:
    """Facts of each column of ``fields`` (column, value as VARIANT): see the module.

    A quoted number is text, since codes have leading zeros and letters; a landed null is no value. Only
    calendar days and times written with T count as such. Objects and arrays are text.
    """
    kind, text = F.schema_of_variant("value"), F.col("value").cast("string")
    quoted = kind == "STRING"
    is_decimal = kind.startswith("DECIMAL")
    met = {
        "flags": kind == "BOOLEAN",
        "wholes": kind == "BIGINT",
        "decimals": is_decimal,
        "floats": kind.isin("DOUBLE", "FLOAT"),
        "days": quoted & text.rlike(_DAY) & text.try_cast("date").isNotNull(),
        "times": quoted & text.rlike(_TIME) & text.try_cast("timestamp").isNotNull(),
    }
    number = (kind == "BIGINT") | is_decimal
    digits = F.when(number, F.length(F.regexp_extract(text, r"^-?0*(\d*)", 1)))
    scale = F.when(is_decimal, F.length(F.regexp_extract(text, r"\.(\d+)$", 1)))
    return fields.groupBy("column").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(kind != "VOID").alias("filled"),
        *[F.count_if(condition).alias(name) for name, condition in met.items()],
        F.coalesce(F.max(digits), F.lit(0)).alias("digits"), F.coalesce(F.max(scale), F.lit(0)).alias("scale"),
    )


def merged(profiles: Iterable[DataFrame]) -> DataFrame:
    """The profile of all rows that several profiles were made of."""
    every = reduce(DataFrame.unionByName, profiles)
    return every.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in COUNTS], *[F.max(c).alias(c) for c in SIZES])


def _type() -> Column:
    all_are = lambda *names: sum((F.col(n) for n in names), F.lit(0)) == F.col("filled")
    scale = F.greatest(F.col("scale"), F.lit(AMOUNT_SCALE))
    wide = F.col("digits") + scale
    decimal = F.format_string("decimal(%d,%d)", F.greatest(wide, F.lit(AMOUNT_DIGITS)), scale)
    return (
        F.when(F.col("filled") == 0, "string")
        .when(all_are("flags"), "boolean")
        .when(all_are("wholes") & (F.col("digits") <= 18), "bigint")
        .when(all_are("wholes", "decimals") & (wide <= 38), decimal)
        .when(all_are("wholes", "decimals", "floats") & (F.col("floats") > 0), "double")
        .when(all_are("days"), "date")
        .when(all_are("days", "times"), "timestamp")
        .otherwise("string")
    )


def typed(profile: DataFrame) -> DataFrame:
    """(column, type, filled): the least type that holds all values of a column, text if it has none."""
    return profile.select("column", _type().alias("type"), "filled")


def schema(profile: DataFrame, reserved: Iterable[str] = (), max_columns: int = MAX_COLUMNS) -> T.StructType:
    """The columns of a profile as a schema, by name.

    Tables tell names apart without case: of several spellings the one with most values is taken. Names in
    ``reserved`` are left out. More than ``max_columns`` names are no table: the call fails.
    """
    found = typed(profile).limit(max_columns + 1).collect()
    if len(found) > max_columns:
        raise ValueError(f"more than {max_columns} field names landed")
    best: dict[str, tuple] = {}
    for r in sorted(found, key=lambda r: (-r["filled"], r["column"])):
        best.setdefault(plain_name(r["column"]).lower(), r)
    taken = {plain_name(name).lower() for name in reserved}
    kept = sorted(r["column"] for name, r in best.items() if name not in taken)
    types = {r["column"]: r["type"] for r in best.values()}
    return T.StructType([T.StructField(c, T.DataType.fromDDL(types[c])) for c in kept])
