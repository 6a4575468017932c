"""One row per key by arrival order.

``row_number() = 1`` makes Spark keep one row per key in every map task before the
shuffle (WindowGroupLimit), so a key that holds a large share of all rows stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerhub.functions.text import quoted


def _total_order(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> list[str]:
    """Arrival columns, then all others by name, so that ties never depend on the run."""
    rest = sorted(set(df.columns) - set(keys) - set(arrival))
    return [*arrival, *rest]


def _one_per_key(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*quoted(keys)).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")
    )


def last_per_key(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Last arrival of each key."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in quoted(_total_order(df, keys, arrival))])


def first_per_key(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """First arrival of each key."""
    return _one_per_key(df, keys, [F.col(c).asc() for c in quoted(_total_order(df, keys, arrival))])
