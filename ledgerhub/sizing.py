"""Size checks that stand before every explicit broadcast.

Spark already broadcasts a side whose file statistics are below
``spark.sql.autoBroadcastJoinThreshold`` and AQE does so from shuffle statistics. The
helpers here cover the case in between: a side that is small next to a very large
table, where a broadcast spares the large table its shuffle. Size is measured, never
assumed, and the caller falls back to an ordinary shuffle join beyond the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerhub.functions.text import quoted

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
MAX_COMPANY_ROWS = 10_000

_FIXED_WIDTH = 16


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and payload bytes, in one distributed pass."""
    width = F.lit(_FIXED_WIDTH * len(df.columns)).cast("long")
    for field in df.schema.fields:
        name = quoted([field.name])[0]
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(F.col(name))))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return row["n"], row["b"] or 0


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Whether the measured size is within the bounds."""
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_within(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``df`` marked for broadcast if its measured size is within the bounds, else ``df``."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def distinct_within(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Distinct rows of ``df``, marked for broadcast if measured small.

    The rows as they are bound the distinct ones from above and need no shuffle to
    measure; only if they are too many are the distinct rows measured themselves, unless
    a sketch, which needs no shuffle either, tells that these are far too many.
    """
    distinct = df.distinct()
    bounds = (max_rows, max_bytes)
    small = fits_broadcast(df, *bounds) or (
        _distinct_estimate(df) <= 2 * max_rows and fits_broadcast(distinct, *bounds))
    return F.broadcast(distinct) if small else distinct


def _distinct_estimate(df: DataFrame) -> int:
    """Distinct rows of ``df``, to some 5 in 100."""
    return df.agg(F.approx_count_distinct(F.xxhash64(*quoted(df.columns)))).first()[0]


def local_copy(
    df: DataFrame, max_rows: int = MAX_COMPANY_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame | None:
    """``df`` as a literal relation if it is within both bounds, else None.

    Meant for aggregates with one row per company. The result carries its exact size,
    so Spark broadcasts it unhinted and the aggregate runs once.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def company_side(df: DataFrame, max_rows: int = MAX_COMPANY_ROWS) -> DataFrame:
    """A per-company frame ready to join: literal when small, unchanged otherwise."""
    local = local_copy(df, max_rows)
    return df if local is None else F.broadcast(local)
