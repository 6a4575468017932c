"""Snapshots as validity intervals: each version of a key once, with the pulls between which it held.

Stored snapshots repeat every row in every pull. A history has a row per version: ``valid_from`` is the
pull that first showed it, ``valid_to`` the first later pull that showed another version or none, NULL
while it is the current one. A version that comes back after an absence or a change is a new row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.sizing import broadcast_within

FROM, TO = "valid_from", "valid_to"


def _digest(columns: Sequence[str]) -> Column:
    """Two versions are the same if this is; NULL is told from an empty text."""
    return F.to_json(F.struct(*quoted(columns)), {"ignoreNullFields": "false"}) if columns else F.lit("")


def _pulls(snapshots: DataFrame, stamp: str, by: Sequence[str]) -> DataFrame:
    """(by, stamp, number, next) of the pulls; numbered by time within ``by``."""
    order = Window.partitionBy(*quoted(by)).orderBy(stamp)
    times = snapshots.select(*quoted(by), stamp).distinct()
    return times.select(*quoted(by), stamp, F.row_number().over(order).alias("_pull"), F.lead(stamp).over(order).alias("_next"))


def collapsed(
    snapshots: DataFrame, keys: Sequence[str], stamp: str = "snapshot_ts", by: Sequence[str] = ("Entity",),
    pulls: DataFrame | None = None,
) -> DataFrame:
    """Versions (keys, other columns, valid_from, valid_to) of snapshot rows.

    Pulls are those of ``by``, the company, since companies may be pulled at different times; ``by`` is part
    of ``keys``, or empty if all are pulled together. ``pulls`` (by, stamp) names pulls that showed no row at
    all as well; those of the rows are found by themselves. A key twice in a pull counts as one row if the
    rows are equal; else each different row is a version of its own, and they may overlap. A company
    with most rows is many tasks, since rows are sorted per key. A key has as many rows as there are pulls.
    """
    unknown = set(by) - set(keys)
    if unknown:
        raise ValueError(f"{', '.join(sorted(unknown))} must be among the keys")
    times = snapshots.select(*quoted(by), stamp)
    numbered = _pulls(times if pulls is None else times.unionByName(pulls.select(*quoted(by), stamp)), stamp, by)
    values = [c for c in snapshots.columns if c not in (*keys, stamp)]
    distinct = snapshots.withColumn("_same", _digest(values)).dropDuplicates([*keys, stamp, "_same"])
    placed = _with_pull(distinct, numbered, [*by, stamp])
    version = Window.partitionBy(*quoted(keys), "_same").orderBy("_pull")
    run = placed.withColumn("_run", F.col("_pull") - F.row_number().over(version))
    found = run.groupBy(*quoted(keys), "_same", "_run").agg(
        *[F.first(quoted([c])[0]).alias(c) for c in values],
        F.min(stamp).alias(FROM), F.max_by("_next", "_pull").alias(TO))
    return found.select(*quoted(keys), *quoted(values), FROM, TO)


def _with_pull(rows: DataFrame, numbered: DataFrame, on: list[str]) -> DataFrame:
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in quoted(on)]
    joined = rows.alias("a").join(broadcast_within(numbered).alias("b"), same)
    return joined.select("a.*", "b._pull", "b._next")


def extended(
    history: DataFrame, pull: DataFrame, taken_at: Column, keys: Sequence[str], by: Sequence[str] = ("Entity",),
    complete: DataFrame | None = None,
) -> DataFrame:
    """The history after one more pull, later than all before; old snapshots aren't read for it.

    Current versions that the pull shows unchanged stay open, the others of its companies end, what it shows
    anew begins. ``complete`` (by) are companies whose pull was whole: one without rows ends all its
    versions. Versions of other companies, and ended ones, stay as they are. One full join by key and version.
    """
    values = [c for c in history.columns if c not in (*keys, FROM, TO)]
    open_, closed = history.where(f"{TO} is null"), history.where(f"{TO} is not null")
    pulled = pull.select(*quoted(by)) if complete is None else pull.select(*quoted(by)).unionByName(complete.select(*quoted(by)))
    pulled = pulled.distinct().withColumn("_pulled", F.lit(True))
    shape = [*quoted(keys), *quoted(values)]
    sides = open_.select(*shape, FROM, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        pull.select(*shape, F.lit(None).cast(history.schema[FROM].dataType).alias(FROM), F.lit(0).alias("_old"), F.lit(1).alias("_new")))
    met = sides.withColumn("_same", _digest(values)).groupBy(*quoted(keys), "_same").agg(
        *[F.first(quoted([c])[0]).alias(c) for c in values], F.min(FROM).alias(FROM),
        F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    if by:
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in quoted(by)]
        met = met.alias("a").join(broadcast_within(pulled).alias("b"), same, "left").select("a.*", "b._pulled")
    else:
        met = met.withColumn("_pulled", F.lit(True))
    ends = (F.col("_old") == 1) & (F.col("_new") == 0) & F.col("_pulled")
    current = met.select(
        *shape, F.coalesce(FROM, taken_at).alias(FROM),
        F.when(ends, taken_at).cast(history.schema[TO].dataType).alias(TO))
    return closed.select(*shape, FROM, TO).unionByName(current)


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The versions that held at a time, without the interval's columns."""
    return history.where((F.col(FROM) <= at) & (F.col(TO).isNull() | (at < F.col(TO)))).drop(FROM, TO)


def joined_as_of(rows: DataFrame, history: DataFrame, keys: Sequence[str], at: str, how: str = "left") -> DataFrame:
    """``rows`` with the version of their key that held at the time in column ``at``.

    A join on the key with the interval as a further condition: versions of a key don't overlap, so a row
    meets at most one, and of a hot key the rows are split by adaptive execution while its versions, no more than
    pulls, are copied. Columns of the history that ``rows`` has too are left out; a NULL key meets none.
    """
    values = [c for c in history.columns if c not in (*keys, FROM, TO) and c not in rows.columns]
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in quoted(keys)]
    time = F.col(f"a.{quoted([at])[0]}")
    inside = (F.col(f"b.{FROM}") <= time) & (F.col(f"b.{TO}").isNull() | (time < F.col(f"b.{TO}")))
    joined = rows.alias("a").join(history.alias("b"), [*on, inside], how)
    return joined.select("a.*", *[F.col(f"b.{c}") for c in quoted(values)])
