"""Logged loads tell what they inserted and updated, and notice a table that lost, repeated or kept rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerhub.plans import catalog, effects, extract
from ledgerhub.scratch import run_folder, written_once
from ledgerhub.sinks import tables

DDL = "id INT, v STRING, page_no INT, pos INT, Entity STRING"
KINDS = [catalog.MERGE, catalog.APPEND_MERGE, catalog.APPEND, catalog.REPLACE_ALL, catalog.REPLACE_LAST, catalog.INSERT_ABSENT]


def frame(spark, *rows):
    return spark.createDataFrame([(i, v, 1, p, e) for p, (i, v, e) in enumerate(rows)], DDL)


def made(spark, *rows, buckets=2):
    name = f"t_{uuid.uuid4().hex}"
    first = frame(spark, *rows).drop("page_no", "pos")
    wide = first.select(F.col("id").cast("long").alias("id"), "v", "Entity")
    tables.create(spark, name, wide.schema, run_folder(spark, "test"), keys=["id"], buckets=buckets)
    if rows:
        tables.refresh(wide, name)
    return name


def entry_of(kind):
    return catalog.Dataset("t", "s", kind, keys=("id", "Entity"), entry_no="id")


def logged(spark, rows, kind, name, batch):
    log = run_folder(spark, "log")
    extract.logged_run(entry_of(kind), batch, name, "2024-05-02", log)
    return rows(spark.read.parquet(log), "company_name", "Status", "RecordsInserted", "error_details")


@pytest.mark.parametrize("kind,first,again", [
    (catalog.INSERT_ABSENT, 2, 0), (catalog.APPEND, 2, 0), (catalog.APPEND_MERGE, 2, 0), (catalog.MERGE, 3, 3), (catalog.REPLACE_ALL, 3, 3),
    (catalog.REPLACE_LAST, 3, 3),
])
def test_numbers_of_the_log(spark, rows, kind, first, again):
    name = made(spark, (1, "a", "A"))
    batch = frame(spark, (1, "b", "A"), (2, "b", "A"), (3, "b", "A"))
    updated = first - 2
    text = f"Rows inserted: 2, rows updated: {updated}." if updated else "Total rows inserted: 2."
    assert logged(spark, rows, kind, name, batch) == [("A", "Success", first, text)]
    second = logged(spark, rows, kind, name, batch)
    if kind in (catalog.APPEND, catalog.APPEND_MERGE):
        assert second == []  # nothing is above the watermark, no company landed
    else:
        assert second == [("A", "Success", again, f"Rows inserted: 0, rows updated: {again}." if again else "Total rows inserted: 0.")]


FAULTS = {
    "lost": lambda df: df.where("id <> 5"),
    "repeated": lambda df: df.unionByName(df.where("id = 5")),
    "unchanged": lambda df: df.withColumn("v", F.when(F.col("id") == 5, "old").otherwise(F.col("v"))),
    "swapped": lambda df: df.withColumn("id", F.when(F.col("id") == 5, 77).otherwise(F.col("id"))),
}


@pytest.mark.parametrize("kind", KINDS)
def test_faults_are_noticed(spark, kind):
    name, entry = made(spark, (1, "a", "A"), (2, "a", "B"), buckets=1), entry_of(kind)
    batch = extract.batch_of(entry, frame(spark, (5, "new", "A"), (6, "new", "A"), (7, "new", "B")), name, "2024-05-02")
    before = written_once(effects.expected(entry, batch, name), "expected")
    marks = written_once(extract.marks_of(entry, spark, name), "marks")
    extract.apply(entry, batch, name)
    whole = written_once(spark.table(name), "whole")
    check = lambda: {r["Entity"]: r["status"] for r in effects.load_check(before, effects.seen(entry, batch, name, marks)).collect()}
    assert check() == {"A": "Success", "B": "Success"}
    for fault, change in FAULTS.items():
        tables.refresh(change(whole), name)
        assert check() == {"A": "Error", "B": "Success"}, fault
    tables.refresh(whole.where("Entity = 'B'"), name)
    assert check() == {"A": "Error", "B": "Success"}


def test_a_load_that_loses_rows_is_logged_as_error(spark, rows, monkeypatch):
    name = made(spark, (1, "a", "A"))
    original = extract.apply

    def loses(entry, batch, table, *more):
        original(entry, batch.where("id <> 3"), table, *more)

    monkeypatch.setattr(extract, "apply", loses)
    batch = frame(spark, (2, "b", "A"), (3, "b", "A"), (4, "b", "B"))
    assert logged(spark, rows, catalog.MERGE, name, batch) == [
        ("A", "Error", 2, "Rows expected: 2, rows found: 1."), ("B", "Success", 1, "Total rows inserted: 1.")]
