"""Load patterns as pure functions: target and batch in, rows out.

Three treatments of repeated keys in a batch exist side by side and must not be mixed
up: :func:`replace_all` keeps all, :func:`replace_last` keeps the last and
:func:`insert_absent` keeps the first. :func:`upsert` refuses them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.operators.latest import first_per_key, last_per_key
from ledgerhub.operators.presence import absent, present
from ledgerhub.operators.watermark import above_watermark
from ledgerhub.sizing import fits_broadcast


def fan_out(pulls: Iterable[DataFrame]) -> DataFrame:
    """All pulls as one frame, columns by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pulls)


def append_above(
    target: DataFrame, batch: DataFrame, entry_no: str, entity: str = "Entity", default: int = 0
) -> DataFrame:
    """Target plus the batch rows above each company's watermark."""
    new = above_watermark(batch, target, entry_no, entity, default)
    return target.unionByName(new.select(*quoted(target.columns)))


def unique_batch(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch itself; fails the job when a key occurs twice.

    Of each key the map tasks pass on two rows at most (``row_number() <= 2``), so even a
    batch made of one key fails fast instead of filling one task. Rows are sorted by key, as
    a join by key needs them anyway.
    """
    names = quoted(keys)
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    message = F.concat(F.lit("upsert batch repeats key "), F.to_json(F.struct(*names)))
    once = F.when(F.col("_place") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return batch.withColumn("_place", place).where("_place <= 2").where(once).drop("_place")


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], measured: bool = False
) -> DataFrame:
    """Merge: a matched row takes the batch's columns, an unmatched batch row is inserted.

    Columns the batch does not have keep the target's value on a match and are NULL on
    an insert. One full join does both, with each side shuffled once. ``measured`` sizes the
    batch first and broadcasts it when it is small: then the target is updated where it lies,
    without a shuffle.
    """
    unique = unique_batch(batch, keys)
    changed = [c for c in batch.columns if c not in keys]
    source = unique.select(
        *quoted(keys), F.struct(F.lit(True).alias("_hit"), *quoted(changed)).alias("_new")
    )
    matched = F.col("_new._hit").isNotNull()

    def value(column: str) -> Column:
        name = quoted([column])[0]
        if column not in changed:
            return F.col(name)
        return F.when(matched, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(column)

    columns = [value(c) for c in target.columns]
    if not (measured and fits_broadcast(batch)):
        return target.join(source, list(keys), "full_outer").select(*columns)
    updated = target.join(F.broadcast(source), list(keys), "left").select(*columns)
    known = target.select(*quoted(keys)).join(
        F.broadcast(batch.select(*quoted(keys))), list(keys), "left_semi"
    )
    inserted = absent(unique, known, keys)
    return updated.unionByName(inserted, allowMissingColumns=True).select(*quoted(target.columns))


def replace_all(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], measured: bool = False
) -> DataFrame:
    """Delete matching target rows, then insert the whole batch, repeats included."""
    return absent(target, batch, keys, measured).unionByName(batch)


def replace_last(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    measured: bool = False,
) -> DataFrame:
    """Delete matching target rows, then insert the last arrival of each key."""
    latest = last_per_key(batch, keys, arrival)
    return absent(target, batch, keys, measured).unionByName(latest.select(*quoted(target.columns)))


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    required: str | None = None,
) -> DataFrame:
    """First arrival of each key that the target does not hold yet.

    Rows without the ``required`` column are left out. The target is cut down to the
    batch's keys first, so it is scanned but not shuffled while those are measured small.
    """
    usable = batch.where(F.col(required).isNotNull()) if required else batch
    known = present(target.select(*quoted(keys)), usable, keys, measured=True)
    return absent(first_per_key(usable, keys, arrival), known, keys)


def insert_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    required: str | None = None,
) -> DataFrame:
    """Target, never updated, plus :func:`new_rows`."""
    new = new_rows(target, batch, keys, arrival, required)
    return target.unionByName(new.select(*quoted(target.columns)))
