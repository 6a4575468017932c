"""What a load does to stored rows, worked out before it runs, and whether the table shows it afterwards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerhub.functions.text import quoted
from ledgerhub.operators import load
from ledgerhub.operators.binding import ENTITY, without
from ledgerhub.operators.latest import last_per_key
from ledgerhub.operators.presence import flagged, keyed, whole_key
from ledgerhub.operators.watermark import above_marks
from ledgerhub.plans import catalog
from ledgerhub.plans.catalog import Dataset
from ledgerhub.scratch import written_once
from ledgerhub.sinks import tables

ARRIVAL = ("page_no", "pos")
NUMBERED = (catalog.APPEND, catalog.APPEND_MERGE)
REFRESHES = (catalog.REFRESH, catalog.STAGED_REFRESH, catalog.REPORT)


def stored_columns(entry: Dataset, rows: DataFrame) -> DataFrame:
    return without(rows, [*entry.skipped, *ARRIVAL])


def change_of(entry: Dataset, held: bool = False) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """What a batch makes of stored rows, for the loads that replace some.

    ``held`` says that all these rows have a key of the batch: a load that deletes such rows doesn't look for them again.
    """
    def change(target: DataFrame, batch: DataFrame) -> DataFrame:
        stored = stored_columns(entry, batch)
        if held and entry.load in (catalog.REPLACE_ALL, catalog.REPLACE_LAST):
            target = target.where(F.lit(False))
            if entry.load == catalog.REPLACE_ALL:
                return target.unionByName(stored)
            return target.unionByName(last_per_key(batch, entry.keys, ARRIVAL).select(*quoted(target.columns)))
        if entry.load == catalog.REPLACE_ALL:
            return load.replace_all(target, stored, entry.keys, measured=True)
        if entry.load == catalog.REPLACE_LAST:
            return load.replace_last(target, batch, entry.keys, ARRIVAL, measured=True)
        return load.upsert(target, stored, entry.keys, measured=True)

    return change


def held_before(entry: Dataset, batch: DataFrame, table: str) -> DataFrame | None:
    """The stored rows with a key of the batch, stored once for all that is asked of them; None for plain appends."""
    if entry.load == catalog.APPEND:
        return None
    return written_once(tables.rows_of_batch(batch, table, entry.keys), "held")


def replaced_and_added(
    entry: Dataset, batch: DataFrame, table: str, old: DataFrame | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """The stored rows that a batch replaces, None if it replaces none, and those it puts in their place.

    ``old`` are the stored rows with a key of the batch, if they are at hand. All of them give way to rows of
    the batch, so these don't meet them again, unless they take columns from them that the batch lacks.
    """
    if entry.load == catalog.APPEND:
        return None, batch
    if old is None:
        old = tables.rows_of_batch(batch, table, entry.keys)
    if entry.load == catalog.INSERT_ABSENT:
        return None, load.new_rows(old, batch, entry.keys, ARRIVAL)
    whole = set(old.columns) <= set(stored_columns(entry, batch).columns)
    return old, change_of(entry, True)(old.where(F.lit(False)) if whole else old, batch)


def _as_stored(rows: DataFrame, table: str, *more: str) -> DataFrame:
    """Rows in the columns and types of the table, then ``more`` of their own; columns that they lack are NULL."""
    fields = [f for f in rows.sparkSession.table(table).schema.fields if f.name != tables.BUCKET]
    own = {c.lower(): c for c in rows.columns}
    value = lambda f: F.col(quoted([own[f.name.lower()]])[0]) if f.name.lower() in own else F.lit(None)
    return rows.select(*[value(f).cast(f.dataType).alias(f.name) for f in fields], *more)


def _digest(schema: T.StructType) -> Column:
    """Hash of a row's values, whichever order its columns have; a null counts, and so does the sign of a zero."""
    parts = []
    for field in sorted(schema.fields, key=lambda f: f.name):
        value, kind = F.col(quoted([field.name])[0]), field.dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            told = value.cast("string")
        else:
            told = value if isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType) else F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        parts += [value.isNull(), told]
    return F.xxhash64(*parts)


def _facts(df: DataFrame, names: Sequence[str], **counted: Column) -> DataFrame:
    """Per row its company and what it adds to each of ``names``; others are 0."""
    parts = {n: F.lit(0) for n in names} | ({} if "digest" in counted else {"digest": _digest(df.schema)}) | counted
    return df.select(F.col(ENTITY), *[parts[n].cast(_kind(n)).alias(n) for n in names])


def _kind(name: str) -> str:
    return "decimal(38,0)" if name.endswith("digest") else "long"


EXPECTED = ["pulled", "inserted", "updated", "rows", "digest"]


def expected(entry: Dataset, batch: DataFrame, table: str, stored: DataFrame | None = None) -> DataFrame:
    """Per company, before the load: rows pulled, keys' rows to be inserted and to be updated, and how many rows
    the table will hold of those that :func:`seen` looks at, with a digest of them.

    Reads the batch, and of the table rows with its keys, which are ``stored`` if they are at hand. To be stored
    before the table is written.
    """
    old, added = replaced_and_added(entry, batch, table, stored)
    one, none = F.lit(1), F.lit(0)
    pulled = batch.select(ENTITY).withColumn("pulled", one)
    if old is None:
        known = added.withColumn("_known", F.lit(False))
    else:
        known = flagged(added, old, entry.keys, "_known")
    held = _as_stored(known, table, "_known")
    # one pass over what is added, which may take a sort of the batch: each row tells all it adds to the sums
    whole = F.lit(True) if entry.load == catalog.APPEND else whole_key(entry.keys)
    digest = _digest(held.drop("_known").schema)
    nothing = {n: F.lit(0).cast(_kind(n)).alias(n) for n in EXPECTED}
    parts = [
        pulled.select(ENTITY, *[nothing[n] if n != "pulled" else n for n in EXPECTED]),
        _facts(
            held, EXPECTED, inserted=F.when(F.col("_known"), none).otherwise(one), updated=F.when(F.col("_known"), one).otherwise(none),
            rows=F.when(whole, one).otherwise(none), digest=F.when(whole, digest).otherwise(none)),
    ]
    if entry.load == catalog.INSERT_ABSENT:
        stored = tables.rows_of_batch(batch, table, entry.keys) if stored is None else stored
        parts.append(_facts(keyed(_as_stored(stored, table), entry.keys)[0], EXPECTED, rows=one))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(ENTITY).agg(*[F.sum(n).alias(n) for n in EXPECTED])


def seen(entry: Dataset, batch: DataFrame, table: str, marks: DataFrame | None) -> DataFrame:
    """The stored rows by which a load is judged: those with a key of the batch, or above the watermarks before it."""
    if entry.load == catalog.APPEND:
        return above_marks(batch.sparkSession.table(table), marks, entry.entry_no).drop(tables.BUCKET)
    return tables.rows_of_batch(batch, table, entry.keys)


def load_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per company pulled, inserted, updated, rows, found and status of a load: ``expected`` against ``seen``.

    It fails if rows are missing, are too many or have other values than the load should have left.
    """
    names = [*EXPECTED, "found", "found_digest"]
    found = _facts(after, ["rows", "digest"], rows=F.lit(1)).select(
        ENTITY, *[F.lit(0).cast(_kind(n)).alias(n) for n in EXPECTED], F.col("rows").alias("found"), F.col("digest").alias("found_digest"))
    told = before.select(ENTITY, *EXPECTED, *[F.lit(0).cast(_kind(n)).alias(n) for n in names[-2:]])
    both = told.unionByName(found).groupBy(ENTITY).agg(*[F.sum(n).alias(n) for n in names])
    good = (F.col("rows") == F.col("found")) & (F.col("digest") == F.col("found_digest"))
    return both.select(
        ENTITY, *[F.col(n).cast("long").alias(n) for n in ("pulled", "inserted", "updated", "rows", "found")],
        F.when(good, "Success").otherwise("Error").alias("status"))
