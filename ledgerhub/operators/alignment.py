"""Amounts of several sources side by side per (account, company)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerhub.functions.money import AMOUNT

KEYS = ["account", "Entity"]
EXACT = "decimal(28,8)"


def aligned_amounts(driving: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Sum of every source for each key of the driving set; a missing side is zero.

    ``driving`` has account and Entity, every source those and amount. All inputs meet in
    one union below one aggregate: sums are formed in the map tasks, there is a single
    exchange instead of one per source, and no account can become a skewed join key.
    Keys outside the driving set are left out. Amounts are summed as they are and rounded once.
    """
    def slots(filled: str | None):
        return [
            (F.col("amount").cast(EXACT) if name == filled else F.lit(None).cast(EXACT)).alias(name)
            for name in sources
        ]

    parts = [driving.select(*KEYS, F.lit(1).alias("_driving"), *slots(None))]
    parts += [
        source.select(*KEYS, F.lit(0).alias("_driving"), *slots(name))
        for name, source in sources.items()
    ]
    union = reduce(DataFrame.unionByName, parts)
    sums = [F.coalesce(F.bround(F.sum(name), 2), F.lit(0)).cast(AMOUNT).alias(name) for name in sources]
    summed = union.groupBy(*KEYS).agg(F.max("_driving").alias("_driving"), *sums)
    return summed.where("_driving = 1").drop("_driving")
