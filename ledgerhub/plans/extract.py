"""Runs a catalog entry: landed records in, changed table out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerhub.functions.text import plain_name
from ledgerhub.operators import inference, load
from ledgerhub.operators.binding import ENTITY, bind, landed_drift, positional
from ledgerhub.operators.changes import modified_since, of_kinds
from ledgerhub.operators.watermark import above_marks, above_watermark, high_watermarks
from ledgerhub.plans import catalog, effects, run_log, schemas
from ledgerhub.plans.catalog import Dataset
from ledgerhub.plans.effects import ARRIVAL, NUMBERED, REFRESHES, change_of, stored_columns
from ledgerhub.scratch import written_once
from ledgerhub.sinks import files, tables
from ledgerhub.sources import pages, reports


def selected(entry: Dataset, landed: DataFrame, run_date: str) -> DataFrame:
    """The landed rows the entry loads: its kinds, and changes since the day before."""
    rows = landed
    if entry.kinds:
        column, kinds = entry.kinds
        rows = of_kinds(rows, column, kinds)
    if entry.changed:
        rows = modified_since(rows, entry.changed, run_date)
    return rows


def loaded(
    entry: Dataset,
    target: DataFrame | None,
    landed: DataFrame,
    run_date: str,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Table content after the run, without writing anything."""
    batch = selected(entry, landed, run_date)
    stored = stored_columns(entry, batch)
    if target is None or entry.load in REFRESHES:
        return stored
    if entry.load == catalog.APPEND:
        return load.append_above(target, stored, entry.entry_no)
    if entry.load == catalog.APPEND_MERGE:
        return load.upsert(target, above_watermark(stored, target, entry.entry_no), entry.keys)
    if entry.load == catalog.MERGE:
        return load.upsert(target, stored, entry.keys)
    if entry.load == catalog.REPLACE_ALL:
        return load.replace_all(target, stored, entry.keys)
    if entry.load == catalog.REPLACE_LAST:
        return load.replace_last(target, batch, entry.keys, arrival)
    if entry.load == catalog.INSERT_ABSENT:
        return load.insert_absent(target, batch, entry.keys, arrival)
    raise ValueError(f"no load pattern {entry.load}")


def pulled(entry: Dataset, landed: DataFrame, table: str, run_date: str) -> DataFrame:
    """The landed rows a run will apply to the stored table."""
    rows = selected(entry, landed, run_date)
    if entry.load in NUMBERED:
        return above_marks(rows, marks_of(entry, landed.sparkSession, table), entry.entry_no)
    return rows


def marks_of(entry: Dataset, spark: SparkSession, table: str) -> DataFrame:
    """Watermarks kept with the last load; found by a scan of the table if there are none."""
    kept = tables.kept_marks(spark, table)
    return high_watermarks(spark.table(table), entry.entry_no) if kept is None else kept


def _apply_numbered(entry: Dataset, batch: DataFrame, table: str, write: Callable[[], None]) -> None:
    """A load above watermarks: what it adds to them is kept for the next one."""
    spark = batch.sparkSession
    old = written_once(marks_of(entry, spark, table), "marks")
    new = high_watermarks(batch, entry.entry_no)
    marks = written_once(old.unionByName(new).groupBy(ENTITY).agg(F.max("max_entry_no").alias("max_entry_no")), "marks")
    write()
    tables.keep_marks(marks, table)


def run(
    entry: Dataset,
    landed: DataFrame,
    table: str,
    run_date: str,
    complete: DataFrame | None = None,
    registered: DataFrame | None = None,
) -> None:
    """Load into a stored table, touching as little of it as the pattern allows.

    A refresh replaces the companies that landed and keeps the others, such as those whose
    pull was rejected. ``complete`` are the companies whose pull was whole: one without rows
    is emptied. ``registered`` are all companies there are: others are removed.
    """
    apply(entry, batch_of(entry, landed, table, run_date), table, complete, registered)


def batch_of(entry: Dataset, landed: DataFrame, table: str, run_date: str) -> DataFrame:
    """What a run applies; stored once if applying it takes more than one pass."""
    rows = pulled(entry, landed, table, run_date)
    return rows if entry.load in REFRESHES else written_once(rows, "batch")


def apply(
    entry: Dataset,
    batch: DataFrame,
    table: str,
    complete: DataFrame | None = None,
    registered: DataFrame | None = None,
    held: DataFrame | None = None,
) -> None:
    """``held`` are the stored rows with a key of the batch (``effects.held_before``), if they are at hand."""
    if entry.load in REFRESHES:
        stored = stored_columns(entry, batch)
        if ENTITY in stored.columns:
            tables.refresh_companies(stored, table, complete, registered)
        else:
            tables.swap(stored, table)
    elif entry.load == catalog.APPEND:
        _apply_numbered(entry, batch, table, lambda: tables.append(stored_columns(entry, batch), table))
    elif entry.load == catalog.APPEND_MERGE:
        _apply_numbered(entry, batch, table, lambda: tables.change_companies(
            batch, table, entry.keys, change_of(entry, held is not None), held=held))
    elif entry.load == catalog.INSERT_ABSENT:
        target = batch.sparkSession.table(table)
        new = load.new_rows(target, batch, entry.keys, ARRIVAL)
        tables.append(written_once(stored_columns(entry, new), "absent"), table)
    else:
        tables.change_companies(batch, table, entry.keys, change_of(entry, held is not None), held=held)


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def logged_run(
    entry: Dataset, landed: DataFrame, table: str, run_date: str, log_folder: str,
    category: str = "DWH_extract",
    complete: DataFrame | None = None,
    registered: DataFrame | None = None,
    now: Callable[[], datetime] = utc_now,
) -> None:
    """:func:`run` with its rows in the run log; a failure is logged and raised.

    A load of companies leaves a row for each, with the rows inserted and updated. It is checked by reading
    back what the load should have left (``plans/effects.py``; a refresh by its rows), so a
    load that lost, repeated or did not change rows is an error of its company. A failed run leaves a row
    for each company that landed, or one row if even that is not known.
    """
    spark, start = landed.sparkSession, now()

    def log(status: str, records: int | None, details: str) -> None:
        row = run_log.log_row(
            spark, status, category, entry.target, start, now(), records, details
        )
        files.append_rows(row, log_folder)

    def log_companies(runs: DataFrame) -> None:
        timed = runs.withColumns({
            "started": F.lit(start), "ended": F.lit(now()), "uri": F.lit("N/A"),
        })
        files.append_rows(run_log.log_rows(timed, category, entry.target), log_folder)

    try:
        batch = batch_of(entry, landed, table, run_date)
        checked = ENTITY in batch.columns and entry.load not in REFRESHES
        held = effects.held_before(entry, batch, table) if checked else None
        before = written_once(effects.expected(entry, batch, table, held), "expected") if checked else None
        marks = written_once(marks_of(entry, spark, table), "marks") if entry.load == catalog.APPEND else None
        apply(entry, batch, table, complete, registered, held)
    except Exception as error:
        details = (str(error).splitlines() or [type(error).__name__])[0]
        if ENTITY in landed.columns:
            try:
                failed = landed.select(F.col(ENTITY).alias("company")).distinct().select(
                    "company", F.lit(False).alias("ok"), F.lit(None).cast("long").alias("records"),
                    F.lit(details).alias("details"),
                )
                log_companies(written_once(failed, "failed"))
                raise error
            except Exception as second:
                if second is error:
                    raise
        log("Error", None, details)
        raise
    if ENTITY not in batch.columns:
        records = spark.table(table).count()
        log("Success", records, f"Total rows inserted: {records}.")
        return
    if entry.load in REFRESHES:
        told = run_log.load_check(batch, spark.table(table).join(
            batch.select(ENTITY).distinct(), ENTITY, "left_semi"))
        told = told.withColumns({"updated": F.lit(0), "rows": F.col("pulled"), "found": F.col("inserted")})
    else:
        told = effects.load_check(before, effects.seen(entry, batch, table, marks))
    ok = F.col("status") == "Success"
    details = F.when(~ok, F.format_string("Rows expected: %d, rows found: %d.", "rows", "found")).when(
        F.col("updated") > 0, F.format_string("Rows inserted: %d, rows updated: %d.", "inserted", "updated")).otherwise(
        F.format_string("Total rows inserted: %d.", "inserted"))
    log_companies(written_once(told.select(
        F.col(ENTITY).alias("company"), ok.alias("ok"), (F.col("inserted") + F.col("updated")).alias("records"),
        details.alias("details")), "checked"))


def landed_records(landing: DataFrame, store: bool = True) -> tuple[DataFrame, DataFrame]:
    """Records of companies whose page chain is whole, and the companies to reject.

    The pages are needed twice; ``store`` parses them once and keeps them as Parquet below
    the shared folder in between.
    """
    if store:
        landing = written_once(landing, "pages")
    status = pages.chain_status(landing)
    whole = pages.complete_pages(landing, status)
    return pages.records(whole), pages.incomplete_companies(status)


def declared(entry: Dataset, schema: T.StructType | None = None) -> T.StructType:
    """The columns a job loads: the caller's, or those declared for its table."""
    found = schema or schemas.schema_of(entry.target)
    if found is None:
        raise ValueError(f"no columns are declared for {entry.target}")
    return found


def bound(entry: Dataset, records: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Landed records with the declared columns, typed, their company and their place in the pull."""
    place = [f for f in records.schema.fields if f.name in (ENTITY, *ARRIVAL)]
    return bind(records, T.StructType([*declared(entry, schema).fields, *place]))


def run_landed(
    spark: SparkSession,
    entry: Dataset,
    folder: str,
    table: str,
    run_date: str,
    log_folder: str,
    landed: T.StructType | None = None,
    schema: T.StructType | None = None,
    registered: DataFrame | None = None,
    now: Callable[[], datetime] = utc_now,
) -> tuple[DataFrame, DataFrame]:
    """From landed pages to the stored table: chain check, binding, load, log with load check.

    Gives the companies whose pull was rejected and the drift report. ``landed`` are the
    record's fields as they land, by default the declared ones. Pages are parsed once; records and
    report are taken from what is kept of that.
    """
    wanted = declared(entry, schema)
    return _run_pages(spark, entry, _kept_pages(spark, folder), table, run_date, log_folder, landed, wanted, registered, now)


def run_inferred(
    spark: SparkSession,
    entry: Dataset,
    folder: str,
    table: str,
    run_date: str,
    log_folder: str,
    store: str,
    buckets: int = 1,
    registered: DataFrame | None = None,
    now: Callable[[], datetime] = utc_now,
) -> tuple[DataFrame, DataFrame]:
    """:func:`run_landed` for a job of which no columns are declared.

    The first run infers them from what landed whole and makes the table below ``store``. From then on
    the table's columns are the declared ones: fields that come later, and values that don't fit any
    more, are in the drift report. A first run in which no record landed leaves no table.
    """
    landing = _kept_pages(spark, folder)
    if not spark.catalog.tableExists(table):
        whole = pages.complete_pages(landing, pages.chain_status(landing))
        found = inference.schema(written_once(inference.profile(pages.fields(whole)), "profile"), (ENTITY, *ARRIVAL))
        if len(found):
            gone = {plain_name(c).lower() for c in entry.skipped}
            kept = [f for f in found.fields if plain_name(f.name).lower() not in gone]
            keys = [k for k in entry.keys if k != ENTITY]
            stored = T.StructType([*kept, T.StructField(ENTITY, T.StringType())])
            tables.create(spark, table, stored, store, keys=keys, buckets=buckets if keys else 1)
        else:
            status = pages.chain_status(landing)
            counts = written_once(pages.field_counts(pages.fields(whole)), "fields")
            return pages.incomplete_companies(status), landed_drift(counts, found)
    own = [f for f in spark.table(table).schema.fields if f.name not in (ENTITY, tables.BUCKET)]
    return _run_pages(
        spark, entry, landing, table, run_date, log_folder, None, T.StructType(own), registered, now)


def _kept_pages(spark: SparkSession, folder: str) -> DataFrame:
    return written_once(pages.read_pages(spark, folder, pages.RAW), "pages")


def _run_pages(
    spark: SparkSession, entry: Dataset, landing: DataFrame, table: str, run_date: str, log_folder: str,
    landed: T.StructType | None, wanted: T.StructType, registered: DataFrame | None, now: Callable[[], datetime],
) -> tuple[DataFrame, DataFrame]:
    status = written_once(pages.chain_status(landing), "status")
    whole = pages.complete_pages(landing, status)
    records = pages.records(whole, landed or wanted)
    logged_run(
        entry, bound(entry, records, wanted), table, run_date, log_folder,
        complete=status.where("complete"), registered=registered, now=now,
    )
    landing_fields = pages.fields(whole).where(~F.col("column").isin(list(entry.skipped)))
    counts = written_once(pages.field_counts(landing_fields, landed or wanted), "fields")  # the report asks four times
    return pages.incomplete_companies(status), written_once(landed_drift(counts, wanted, landed), "drift")


def landed_report(spark: SparkSession, entry: Dataset, path: str) -> DataFrame:
    """A report of the catalog's width, by position; rows the entry does not want are left out.

    Such rows are told by header names. A report without those columns was cut at its source.
    """
    if not entry.only:
        return reports.positional_report(spark, path, entry.width)
    named = reports.named_report(spark, path)
    wanted = named
    if {column for column, _ in entry.only} <= set(named.columns):
        for column, value in entry.only:
            wanted = wanted.where(F.col(column) == value)
    return positional(wanted, reports.positional_schema(entry.width).names)


def status_extract(relations: DataFrame) -> DataFrame:
    """Number and logistics status of customers or vendors."""
    return relations.select("no", "statusCode3PL", "Entity")


def reload(source: DataFrame, table: str, condition=None) -> None:
    """Full-reload repair; ``condition`` keeps the rows the regular load would keep."""
    rows = source if condition is None else source.where(F.expr(condition))
    tables.refresh(rows, table)
