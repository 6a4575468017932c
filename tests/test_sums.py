"""Kept sums against those of the stored rows, for every kind of load, repeated and broken off runs."""

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerhub.operators import presence
from ledgerhub.plans import balance_sums, catalog, extract
from ledgerhub.scratch import run_folder
from ledgerhub.sinks import tables
from tests.plans_text import plan

DDL = "id INT, no STRING, amount DECIMAL(18,2), page_no INT, pos INT, Entity STRING"
STORED = ["id", "no", "amount", "Entity"]


def frame(spark, *rows):
    from decimal import Decimal

    return spark.createDataFrame(
        [(i, no, None if a is None else Decimal(a), 1, p, e) for p, (i, no, a, e) in enumerate(rows)], DDL)


@pytest.fixture
def stored(spark):
    def made(buckets=3):
        name = f"t_{uuid.uuid4().hex}"
        schema = frame(spark).select(*STORED).schema
        tables.create(spark, name, schema, run_folder(spark, "test"), keys=["id"], buckets=buckets)
        return name, balance_sums.Sums(run_folder(spark, "sums"), "no", "amount")

    return made


def agree(spark, name, sums):
    return balance_sums.apart(spark.table(name), balance_sums.current(spark, sums), sums).collect() == []


FIRST = [(1, "a", "1.10", "A"), (2, "a", "2.20", "A"), (3, "b", None, "A"), (4, "b", "4.00", "B"), (5, None, "5.00", "B"), (6, "z", "0.00", "C")]
SECOND = [(2, "b", "7.00", "A"), (4, "b", "-4.00", "B"), (9, "c", "9.99", "A"), (10, "n", "1.00", "D")]
KINDS = [catalog.MERGE, catalog.APPEND_MERGE, catalog.APPEND, catalog.REPLACE_ALL, catalog.REPLACE_LAST, catalog.INSERT_ABSENT, catalog.REFRESH]


@pytest.mark.parametrize("kind", KINDS)
def test_sums_follow_every_kind_of_load(spark, stored, kind):
    name, sums = stored()
    entry = catalog.Dataset("t", "s", kind, keys=("id", "Entity"), entry_no="id")
    second = SECOND + ([(9, "d", "0.01", "A")] if kind in (catalog.REPLACE_ALL, catalog.REPLACE_LAST, catalog.INSERT_ABSENT, catalog.REFRESH) else [])
    for i, batch in enumerate((FIRST, second, second, [])):
        balance_sums.run(entry, frame(spark, *batch), name, "2024-05-02", sums, f"run{i}")
        assert agree(spark, name, sums)
    assert spark.table(name).count() > 4 and balance_sums.current(spark, sums).count() > 3
    new = balance_sums.compact(spark, sums, run_folder(spark, "sums"))
    assert sorted(balance_sums.current(spark, new).collect(), key=repr) == sorted(balance_sums.current(spark, sums).collect(), key=repr)
    assert agree(spark, name, new)


def test_refresh_takes_off_empty_and_unregistered_companies(spark, stored):
    name, sums = stored()
    entry = catalog.Dataset("t", "s", catalog.REFRESH)
    balance_sums.run(entry, frame(spark, *FIRST), name, "2024-05-02", sums, "one")
    complete = spark.createDataFrame([("A",), ("B",)], "Entity STRING")
    registered = spark.createDataFrame([("A",), ("B",)], "Entity STRING")
    balance_sums.run(entry, frame(spark, (1, "a", "3.00", "A")), name, "2024-05-02", sums, "two", complete, registered)
    assert [(r["account"], r["Entity"], float(r["amount"]), r["rows"]) for r in balance_sums.current(spark, sums).collect()] == [("a", "A", 3.0, 1)]
    assert agree(spark, name, sums)


@pytest.mark.parametrize("kind", [catalog.MERGE, catalog.APPEND, catalog.REFRESH])
def test_a_run_that_ended_between_plan_and_table_is_repeated(spark, stored, kind, monkeypatch):
    name, sums = stored()
    entry = catalog.Dataset("t", "s", kind, keys=("id", "Entity"), entry_no="id")
    balance_sums.run(entry, frame(spark, *FIRST), name, "2024-05-02", sums, "one")
    for broken in ("apply", "late"):
        original = extract.apply

        def fails(*args):
            if broken == "late":
                original(*args)
            raise RuntimeError("lost")

        monkeypatch.setattr(extract, "apply", fails)
        batch = frame(spark, *SECOND) if broken == "apply" else frame(spark, (11, "q", "1.00", "A"), (1, "a", "8.00", "A"))
        before = balance_sums.current(spark, sums).collect()
        with pytest.raises(RuntimeError):
            balance_sums.run(entry, batch, name, "2024-05-02", sums, broken)
        assert balance_sums.current(spark, sums).collect() == before
        monkeypatch.undo()
        for _ in range(2):
            balance_sums.run(entry, batch, name, "2024-05-02", sums, broken)
            assert agree(spark, name, sums)


def test_plans_read_the_batch_and_what_it_touches(spark, stored):
    name, sums = stored(buckets=8)
    rows = spark.range(4000).selectExpr("CAST(id AS INT) AS id", "'a' AS no", "CAST(1 AS DECIMAL(18,2)) AS amount", "concat('c', id % 4) AS Entity")
    tables.refresh(rows, name)
    batch = rows.where("id in (4, 8)")
    old = tables.rows_of_batch(batch, name, ["id", "Entity"])
    text = plan(old)
    assert "PartitionFilters" in text and "IN (" in text
    assert old.count() == 2
    parts = old.select(F.input_file_name()).distinct().count()
    assert parts <= 2
    append = catalog.Dataset("t", "s", catalog.APPEND, entry_no="id")
    removed, added = balance_sums.replaced_and_added(append, batch, name)
    assert removed is None and f"{name}" not in plan(sums.changed(added))


def test_sums_need_companies(spark, stored):
    name, sums = stored()
    with pytest.raises(ValueError, match="per company"):
        balance_sums.run(catalog.Dataset("t", "s", catalog.REFRESH), frame(spark, *FIRST).drop("Entity"), name, "2024-05-02", sums, "x")


@pytest.mark.parametrize("kind", [catalog.MERGE, catalog.REPLACE_ALL, catalog.REPLACE_LAST])
def test_a_load_looks_up_its_rows_once_and_leaves_the_others_as_they_lie(spark, stored, kind, monkeypatch):
    """With keys too many to broadcast: other rows meet the sieve's bits only, not a shuffle by key."""
    name, sums = stored()
    rows = spark.range(3000).selectExpr(
        "CAST(id AS INT) AS id", "'a' AS no", "CAST(1 AS DECIMAL(18,2)) AS amount", "concat('c', id % 4) AS Entity",
        "1 AS page_no", "id AS pos")
    entry = catalog.Dataset("t", "s", kind, keys=("id", "Entity"))
    balance_sums.run(entry, rows, name, "2024-05-02", sums, "one")
    kept, looked = [], []
    replace, present = tables._replace, tables.present

    def replacing(df, table, layout, gone, left=None):
        kept.append((left.count(), plan(left)))
        replace(df, table, layout, gone, left)

    monkeypatch.setattr(presence, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(tables, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(tables, "_replace", replacing)
    monkeypatch.setattr(tables, "present", lambda *a, **k: looked.append(a) or present(*a, **k))
    batch = rows.where("id % 100 < 2").withColumn("amount", F.expr("CAST(3 AS DECIMAL(18,2))"))
    balance_sums.run(entry, batch, name, "2024-05-02", sums, "two")
    assert len(looked) == 1
    (count, text), = kept
    assert 1440 * 0.95 < count <= 1440 and "LeftAnti" in text and "SortMergeJoin" not in text
    assert agree(spark, name, sums)
    stored_now = spark.table(name)
    assert stored_now.count() == stored_now.select("id").distinct().count() == 3000
    assert stored_now.where("(amount = 3) = (id % 100 < 2)").count() == 3000
