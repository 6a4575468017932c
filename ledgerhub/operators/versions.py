"""Merging by version: whatever order rows arrive in, each key ends with its latest version.

A row that lands late, from a repeated poll or a slow source, must not overwrite a newer stored one, and a
deleted key must not come back with an older row. So deletions are stored as rows with a mark, and every
merge keeps the greatest version of what is stored and what arrives. That is associative, commutative and
idempotent: any order, grouping or repetition of batches gives one result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.operators.latest import last_per_key
from ledgerhub.operators.presence import absent
from ledgerhub.sizing import fits_broadcast


def _rank(side: str, columns: Sequence[str], keys: Sequence[str], version: str) -> Column:
    """Rows of a key compare by version, then by all other columns by name; a NULL is the least."""
    rest = sorted(set(columns) - {*keys, version})
    return F.struct(*[F.col(f"{side}.{c}") for c in quoted([version, *rest])])


def latest_versions(rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The greatest version of each key; of equal versions the one that is greater by the other columns."""
    return last_per_key(rows, keys, [version])


def merge_by_version(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], version: str, measured: bool = False
) -> DataFrame:
    """The greatest version of each key over ``target``, which has a row per key, and ``batch``, which may have many.

    Both have the same columns; deletions are rows like others (:func:`live` leaves them out). ``measured``
    sizes the batch first and broadcasts it while it is small: then the target is not shuffled. Rows
    with a NULL in a key are kept as they are.
    """
    new = latest_versions(batch.select(*quoted(target.columns)), keys, version).alias("b")
    old = target.alias("a")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in quoted(keys)]
    newer = _rank("b", target.columns, keys, version) > _rank("a", target.columns, keys, version)

    def picked(takes_new: Column) -> list[Column]:
        return [F.when(takes_new, F.col(f"b.{q}")).otherwise(F.col(f"a.{q}")).alias(c) for c, q in zip(target.columns, quoted(target.columns))]

    if not (measured and fits_broadcast(batch)):
        either = old.withColumn("_old", F.lit(True)).alias("a").join(new, same, "full_outer")
        return either.select(*picked(F.coalesce(newer, F.lit(False)) | F.col("a._old").isNull()))
    hit = new.withColumn("_new", F.lit(True)).alias("b")
    kept = old.join(F.broadcast(hit), same, "left").select(*picked(F.col("b._new").isNotNull() & newer))
    fresh = absent(new, target.select(*quoted(keys)).join(F.broadcast(batch.select(*quoted(keys)).distinct()), list(keys), "left_semi"), keys)
    return kept.unionByName(fresh)


def live(rows: DataFrame, deleted: str) -> DataFrame:
    """Rows that are not marked as deleted; no mark is no deletion."""
    return rows.where(~F.coalesce(F.col(quoted([deleted])[0]), F.lit(False)))
