"""Company-partitioned Parquet tables, with key buckets where single rows change.

A table is partitioned by company, and if it is made with ``buckets`` also by a hash of its
keys: then a change rewrites only the buckets it touches, however large the company. A change
is written to a new folder and the catalog is pointed at it afterwards, partition by
partition; the folders it replaces are removed then. A job that fails leaves the table as it
was, readers never see half a partition, and what does not change is neither read nor written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerhub.functions.text import quoted
from ledgerhub.operators.presence import keyed, parted, present, sievable, sieved
from ledgerhub.sizing import fits_broadcast

ENTITY = "Entity"
BUCKET = "_bucket"
NO_COMPANY = "__HIVE_DEFAULT_PARTITION__"
_KEYS, _BUCKETS = "ledgerhub.keys", "ledgerhub.buckets"

#: The values of a partition's columns, as the catalog shows them.
Spec = tuple[str, ...]


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Layout:
    """Partition columns of a stored table, and what its buckets are made from."""

    entity: str
    keys: tuple[str, ...]
    buckets: int

    @property
    def columns(self) -> list[str]:
        return [self.entity, BUCKET] if self.buckets > 1 else [self.entity]

    def bucket(self) -> Column:
        """Bucket number of a row; keys count by their text, so their types may differ."""
        texts = [F.col(k).cast("string") for k in quoted(self.keys)]
        return F.pmod(F.xxhash64(*texts), F.lit(self.buckets)).cast("int")

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with its bucket, if the table has any."""
        return df.withColumn(BUCKET, self.bucket()) if self.buckets > 1 else df

    def part(self, spec: Spec) -> str:
        pairs = [f"`{self.entity}` = {_literal(spec[0])}"]
        pairs += [f"`{BUCKET}` = {int(n)}" for n in spec[1:]]
        return f"PARTITION ({', '.join(pairs)})"

    def within(self, specs: Iterable[Spec]) -> Column:
        """Whether a row lies in one of the partitions; reaches the partition filter.

        One look-up in a set, however many partitions there are. The bucket comes first: it has no slash.
        """
        company = quoted([self.entity])[0]
        place = company if self.buckets == 1 else f"concat({BUCKET}, '/', {company})"
        names = [_literal("/".join(reversed(spec))) for spec in sorted(specs)]
        return F.expr(f"{place} IN ({', '.join(names)})") if names else F.lit(False)


def create(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    folder: str,
    entity: str = ENTITY,
    keys: Sequence[str] = (),
    buckets: int = 1,
) -> None:
    """An empty table partitioned by company, unless it is there already.

    With ``buckets`` above 1 also by a hash of ``keys``; it then has a last column ``_bucket``.
    """
    fields = [*schema.fields, T.StructField(BUCKET, T.IntegerType())] if buckets > 1 else schema.fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = f"`{entity}`, `{BUCKET}`" if buckets > 1 else f"`{entity}`"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({parts}) "
        f"LOCATION {_literal(folder)} TBLPROPERTIES ("
        f"{_literal(_KEYS)} = {_literal(json.dumps(list(keys)))}, {_literal(_BUCKETS)} = '{buckets}')"
    )


def _marks_name(table: str) -> str:
    return f"{table}_watermarks"


def kept_marks(spark: SparkSession, table: str) -> DataFrame | None:
    """Watermarks kept with a stored table; None if none are, or something was written since."""
    name = _marks_name(table)
    return spark.table(name) if spark.catalog.tableExists(name) else None


def keep_marks(marks: DataFrame, table: str) -> None:
    """Keep watermarks until the table is written to again."""
    spark, name = marks.sparkSession, _marks_name(table)
    folder = f"{_table_folder(spark, table)}_watermarks/{uuid.uuid4().hex}"
    marks.write.parquet(folder)
    create_plain(spark, name, marks.schema, folder)


def _forget_marks(spark: SparkSession, table: str) -> None:
    """Before any write: a job that ends between write and new marks must not leave old ones.

    Their folder goes too, so that runs leave one at most.
    """
    name = _marks_name(table)
    if spark.catalog.tableExists(name):
        folder = _table_folder(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(spark, folder)


def layout_of(spark: SparkSession, table: str, entity: str = ENTITY) -> Layout:
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return Layout(entity, tuple(json.loads(shown.get(_KEYS, "[]"))), int(shown.get(_BUCKETS, 1)))


def create_plain(spark: SparkSession, table: str, schema: T.StructType, folder: str) -> None:
    """An empty table without companies, unless it is there already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION {_literal(folder)}"
    )


def swap(df: DataFrame, table: str) -> None:
    """Full refresh of a table without companies: new folder first, then point at it."""
    spark = df.sparkSession
    old = _table_folder(spark, table)
    base = old.split("/_versions/")[0]
    folder = f"{base}/_versions/{uuid.uuid4().hex}"
    df.select(*quoted(spark.table(table).columns)).write.parquet(folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(folder)}")
    spark.catalog.refreshTable(table)
    if old != base:
        _delete(spark, old)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def companies_of(df: DataFrame, entity: str = ENTITY) -> list[str]:
    """The companies that occur in a batch: no more names than the catalog holds partitions."""
    return sorted({spec[0] for spec in _parts_of(df, [entity])})


def _parts_of(df: DataFrame, columns: list[str]) -> set[Spec]:
    rows = df.select(*[F.col(c).cast("string") for c in quoted(columns)]).distinct().collect()
    if any(None in row for row in rows):
        raise ValueError(f"rows without {columns[0]} cannot be stored")
    return {tuple(row) for row in rows}


def _location(rows: list, heading: str) -> str:
    """The first location below a heading; columns and partitions come before it."""
    names = [r["col_name"] for r in rows]
    start = names.index(heading)
    return rows[names.index("Location", start)]["data_type"].rstrip("/")


def _table_folder(spark: SparkSession, table: str) -> str:
    shown = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return _location(shown, "# Detailed Table Information")


def _remove(spark: SparkSession, base: str, names: set[str], depth: int, but: str) -> None:
    """Delete what partitions of these folder names held before they were moved to the folder ``but``.

    A partition lies right below ``base`` or in one of its versions, ``depth`` folders deep.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    levels = "/".join(["*=*"] * depth)
    for pattern in (levels, f"_versions/*/{levels}"):
        for found in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, pattern)):
            parts = found.getPath().toUri().getPath().split("/")
            if "/".join(parts[-depth:]) in names and parts[-depth - 1] != but:
                store.delete(found.getPath(), True)


def _in_table_order(df: DataFrame, table: str, layout: Layout) -> DataFrame:
    return layout.placed(df).select(*quoted(df.sparkSession.table(table).columns))


def _stored_parts(spark: SparkSession, table: str) -> dict[Spec, str]:
    """Stored partitions and their folder names, from the catalog alone."""
    shown = [row["partition"] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {tuple(unquote(p.split("=", 1)[1]) for p in name.split("/")): name for name in shown}


def _written_parts(spark: SparkSession, table: str, schema: T.StructType, folder: str, layout: Layout) -> dict[Spec, str]:
    """Partitions in a written folder, found by listing it and not by reading rows."""
    incoming = f"{table}_incoming_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(quoted(layout.columns))
    spark.sql(
        f"CREATE TABLE {incoming} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION {_literal(folder)}"
    )
    try:
        spark.catalog.recoverPartitions(incoming)
        return _stored_parts(spark, incoming)
    finally:
        spark.sql(f"DROP TABLE {incoming}")


def _replace(
    df: DataFrame, table: str, layout: Layout, gone: Callable[[set[Spec], set[Spec]], set[Spec]],
    kept: DataFrame | None = None,
) -> None:
    """Store ``df`` as the new content of every partition in it, along with ``kept``.

    ``kept`` are stored rows that don't change: as they lie together already, they are written without a shuffle.

    ``gone(stored, written)`` are further partitions to remove. The rebalance hint splits a
    partition that holds most rows over many tasks and files. The catalog has no statement that moves many
    partitions at once, so they are moved one by one: a reader that plans meanwhile sees each partition
    whole, but old ones beside new ones.
    """
    spark = df.sparkSession
    base, version = _table_folder(spark, table), uuid.uuid4().hex
    folder = f"{base}/_versions/{version}"
    ordered = _in_table_order(df, table, layout)
    every = ordered.hint("rebalance", *layout.columns)
    if kept is not None:
        every = every.unionByName(_in_table_order(kept, table, layout))
    every.write.partitionBy(*layout.columns).parquet(folder)
    written = _written_parts(spark, table, every.schema, folder, layout)
    _forget_marks(spark, table)
    if any(spec[0] == NO_COMPANY for spec in written):
        raise ValueError(f"rows without {layout.entity} cannot be stored")
    names = _stored_parts(spark, table)
    stored = names.keys()

    def place(spec: Spec) -> str:
        return f"LOCATION {_literal(folder + '/' + written[spec])}"

    replaced = sorted(written.keys() & stored)
    dropped = sorted(gone(set(stored), set(written)))
    for spec in replaced:
        spark.sql(f"ALTER TABLE {table} {layout.part(spec)} SET {place(spec)}")
    new = [f"{layout.part(spec)} {place(spec)}" for spec in sorted(written.keys() - stored)]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(new)}")
    if dropped:
        spark.sql(f"ALTER TABLE {table} DROP {', '.join(map(layout.part, dropped))}")
    spark.catalog.refreshTable(table)
    _remove(spark, base, {names[spec] for spec in [*replaced, *dropped]}, len(layout.columns), version)


def replace_companies(
    df: DataFrame,
    table: str,
    entity: str = ENTITY,
    dropped: Callable[[set[str]], set[str]] | None = None,
) -> None:
    """Store ``df`` as the new content of every company in it.

    ``dropped`` says which of the stored companies that are not in ``df`` are removed.
    """
    def gone(stored: set[Spec], written: set[Spec]) -> set[Spec]:
        fresh = {spec[0] for spec in written}
        others = {spec[0] for spec in stored} - fresh
        names = fresh | (dropped(others) if dropped else set())
        return {spec for spec in stored - written if spec[0] in names}

    _replace(df, table, layout_of(df.sparkSession, table, entity), gone)


def refresh(df: DataFrame, table: str, entity: str = ENTITY) -> None:
    """Full refresh: afterwards the table holds ``df`` and nothing else."""
    replace_companies(df, table, entity, dropped=lambda others: others)


def refresh_companies(
    df: DataFrame,
    table: str,
    complete: DataFrame | None = None,
    registered: DataFrame | None = None,
    entity: str = ENTITY,
) -> None:
    """Refresh of the companies that were pulled; all others keep their rows.

    A stored company that is not in ``df`` is removed only if it is in ``complete``, since
    its whole pull was empty, or not in ``registered``. Either may be None: nothing is known.
    """
    def named(frame: DataFrame, names: set[str]) -> set[str]:
        asked = df.sparkSession.createDataFrame([(name,) for name in sorted(names)], f"`{entity}` STRING")
        found = asked.join(frame.select(entity).distinct(), entity, "left_semi")
        return {row[0] for row in found.collect()}

    def gone(others: set[str]) -> set[str]:
        empty = named(complete, others) if complete is not None and others else set()
        left = others - named(registered, others) if registered is not None and others else set()
        return empty | left

    replace_companies(df, table, entity, dropped=gone)


def change_companies(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    change: Callable[[DataFrame, DataFrame], DataFrame],
    entity: str = ENTITY,
    rejects: str | None = None,
    held: DataFrame | None = None,
) -> tuple[list[str], list[str]]:
    """Apply ``change(target, batch)``; gives the companies with rewritten rows, and the others.

    Only partitions in which a key of the batch is stored already are rewritten: companies, or
    buckets of companies. To the others, often all in an incremental load, the change of nothing
    is appended and what they hold is not read beyond its keys. ``keys`` include the company,
    and the keys of the table's buckets if it has any. Repeating the call after a failure is
    harmless: rows that were appended are then found and replaced. That needs a key, so rows
    with a NULL in a key are refused unless ``rejects`` names a folder, which is overwritten
    with them. ``held`` are the stored rows with a key of the batch, if they are at hand
    (:func:`rows_of_batch`): then only these meet the batch and the others are written as they lie. Else
    they are looked up, in partitions that the catalog knows.
    """
    spark = batch.sparkSession
    layout = layout_of(spark, table, entity)
    if layout.buckets > 1 and not set(layout.keys) <= set(keys):
        raise ValueError(f"buckets by {', '.join(layout.keys)} need these among the keys")
    batch, keyless = keyed(batch, keys)
    if rejects is not None:
        keyless.write.mode("overwrite").parquet(rejects)
    elif not keyless.isEmpty():
        raise ValueError(f"rows without {', '.join(keys)} cannot be stored")
    batch, target = layout.placed(batch), spark.table(table)
    touched = _parts_of(batch, layout.columns)
    known = touched & _stored_parts(spark, table).keys()
    if held is not None:
        hit = _parts_of(layout.placed(held), layout.columns)
    elif known:
        stored = target.where(layout.within(known))
        columns = list(dict.fromkeys([*keys, *layout.columns]))
        hit = _parts_of(present(stored.select(*quoted(columns)), batch, keys, measured=True), layout.columns)
    else:
        hit = set()
    fresh = touched - hit

    def changed(rows: DataFrame, specs: set[Spec]) -> DataFrame:
        return change(rows.drop(BUCKET), batch.where(layout.within(specs)).drop(BUCKET))

    if fresh:
        append(changed(target.where(F.lit(False)), fresh), table, entity)
    if hit:
        stored, kept = target.where(layout.within(hit)), None
        if held is None:
            rows = changed(stored, hit)
        else:
            kept, near = parted(stored.drop(BUCKET), held, keys)
            rows = changed(held, hit)
            rows = rows if near is None else rows.unionByName(near)
        _replace(rows, table, layout, lambda _, written: hit - written, kept)
    rewritten = {spec[0] for spec in hit}
    return sorted(rewritten), sorted({spec[0] for spec in fresh} - rewritten)


def rows_of_batch(batch: DataFrame, table: str, keys: Sequence[str], entity: str = ENTITY) -> DataFrame:
    """Stored rows with a key of the batch; only partitions to which the batch's rows belong are read."""
    spark = batch.sparkSession
    layout = layout_of(spark, table, entity)
    if not set(layout.keys) <= set(keys):
        layout = Layout(entity, (), 1)
    whole, _ = keyed(batch, keys)
    touched = _parts_of(layout.placed(whole), layout.columns)
    known = {spec[: len(layout.columns)] for spec in _stored_parts(spark, table)}
    stored = spark.table(table).where(layout.within(touched & known)).drop(BUCKET)
    if not touched & known:
        return stored
    asked = whole.select(*quoted(keys))
    if sievable(stored, asked, keys) and not fits_broadcast(asked) and stored.count() > 4 * asked.count():
        stored = sieved(stored, asked, keys)
    return present(stored, asked, keys, measured=True)


def append(df: DataFrame, table: str, entity: str = ENTITY) -> None:
    """Add rows without touching stored ones."""
    layout = layout_of(df.sparkSession, table, entity)
    _forget_marks(df.sparkSession, table)
    _in_table_order(df, table, layout).hint("rebalance", *layout.columns).write.mode("append").insertInto(table)
