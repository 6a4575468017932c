"""Binding landed records to a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerhub.functions.text import plain_name, quoted
from ledgerhub.functions.times import strict_date

ENTITY = "Entity"


def with_plain_names(df: DataFrame) -> DataFrame:
    """Columns under their plain names."""
    return df.toDF(*[plain_name(c) for c in df.columns])


def _typed(column: Column, landed: T.DataType, wanted: T.DataType) -> Column:
    if landed == wanted:
        return column
    if isinstance(wanted, T.DateType) and isinstance(landed, T.StringType):
        return strict_date(column)
    return column.try_cast(wanted)


def bind(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, case ignored.

    A missing column is NULL, an unparsable value is NULL, further columns are left out
    (see :func:`drift`).
    """
    landed = {plain_name(f.name).lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        source = landed.get(plain_name(field.name).lower())
        if source is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = _typed(F.col(quoted([source.name])[0]), source.dataType, field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def drift(df: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """Declared columns that did not land and landed columns that are not declared."""
    landed = {plain_name(c).lower(): c for c in df.columns}
    declared = {plain_name(f.name).lower(): f.name for f in schema.fields}
    return {
        "missing": [name for key, name in declared.items() if key not in landed],
        "unknown": [name for key, name in landed.items() if key not in declared],
    }


def drift_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`drift` as rows (problem, column, filled): in how many records an unknown column has a value."""
    found = drift(df, schema)
    names = [("missing", n) for n in found["missing"]] + [("unknown", n) for n in found["unknown"]]
    filled = [F.lit(0).cast("long") if p == "missing" else F.count(quoted([n])[0]) for p, n in names]
    rows = [F.struct(F.lit(p).alias("problem"), F.lit(n).alias("column"), c.alias("filled")) for (p, n), c in zip(names, filled)]
    if not rows:
        return df.sparkSession.createDataFrame([], "problem STRING, column STRING, filled BIGINT")
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def landed_drift(counts: DataFrame, schema: T.StructType, parsed: T.StructType | None = None) -> DataFrame:
    """Drift as rows (problem, column, filled) of the fields that landed: (column, filled, unfit) in ``counts``.

    Pages are parsed by the exact names of ``parsed``, by default those of ``schema``: another
    spelling is unknown, and its column is missing. A column with values that are none of its type is
    ``unfit``, ``filled`` being their number. If no record landed there is no report.
    """
    declared = {plain_name(f.name).lower(): f.name for f in schema.fields}
    read = {f.name: plain_name(f.name).lower() for f in (parsed or schema).fields}
    bound = [(name, declared[key]) for name, key in read.items() if key in declared]
    spark = counts.sparkSession
    known = spark.createDataFrame(bound, "column STRING, declared STRING")
    wanted = spark.createDataFrame([(n,) for n in declared.values()], "declared STRING")
    unknown = counts.join(F.broadcast(known), "column", "left_anti").select(
        F.lit("unknown").alias("problem"), "column", "filled")
    here = known.join(counts, "column", "left_semi").select("declared").distinct()
    missing = wanted.join(here, "declared", "left_anti").crossJoin(counts.limit(1).select()).select(
        F.lit("missing").alias("problem"), F.col("declared").alias("column"), F.lit(0).cast("long").alias("filled"))
    unfit = counts.where("unfit > 0").join(F.broadcast(known), "column", "left_semi").select(
        F.lit("unfit").alias("problem"), "column", F.col("unfit").alias("filled"))
    return missing.unionByName(unknown).unionByName(unfit)


def positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns renamed by position; the widths must agree."""
    if len(df.columns) != len(names):
        raise ValueError(f"{len(df.columns)} columns landed, {len(names)} are declared")
    return df.toDF(*names)


def without(df: DataFrame, skipped: Sequence[str]) -> DataFrame:
    """All columns but the skipped ones, names compared in plain form."""
    gone = {plain_name(c).lower() for c in skipped}
    return df.select(*quoted(c for c in df.columns if plain_name(c).lower() not in gone))


def tagged(df: DataFrame, company: str | Column, entity: str = ENTITY) -> DataFrame:
    """Rows with their company in the last column."""
    value = F.lit(company) if isinstance(company, str) else company
    return df.withColumn(entity, value)


def stamped(df: DataFrame, taken_at: Column, name: str = "snapshot_ts") -> DataFrame:
    """Rows with the time of the pull in the first column."""
    return df.select(taken_at.alias(name), "*")


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have every required column, and the others."""
    present = F.lit(True)
    for column in required:
        present = present & F.col(column).isNotNull()
    return df.where(present), df.where(~present)
