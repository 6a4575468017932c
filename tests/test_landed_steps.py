"""Landed loads ask each large step once: pages, fields, added rows, rows held before."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from ledgerhub.plans import catalog, effects, extract
from ledgerhub.scratch import run_folder
from ledgerhub.warehouse_queries import loading
from tests.plans_text import plan
from tests.test_load_check import entry_of, frame, made


def shape(df):
    return plan(df).split("\n\n")[0]


def test_fields_that_landed_are_counted_in_one_pass(spark, rows, tmp_path, monkeypatch):
    """The report takes its counts from what is stored of them, not four times from the records."""
    kept, store = {}, extract.written_once
    monkeypatch.setattr(extract, "written_once", lambda df, purpose: kept.setdefault(purpose, shape(df)) and store(df, purpose))
    (tmp_path / "p.json").write_text(json.dumps(
        {"Entity": "A", "page_no": 1, "value": [{"id": 1, "v": "a", "n": 1}, {"id": "x", "v": [1]}]}))
    schema = T.StructType().add("id", "long").add("v", "string")
    _, drift = extract.run_landed(
        spark, entry_of(catalog.REFRESH), str(tmp_path), made(spark), "2024-05-02", run_folder(spark, "log"), schema=schema)
    assert rows(drift) == [("unfit", "id", 1), ("unknown", "n", 1)]
    assert "Generate" not in kept["drift"] and kept["fields"].count("Generate") == 2


@pytest.mark.parametrize("kind,windows", [(catalog.REPLACE_LAST, 1), (catalog.MERGE, 1), (catalog.REPLACE_ALL, 0)])
def test_added_rows_are_sorted_once_for_what_is_expected(spark, kind, windows):
    name, batch = made(spark, (1, "a", "A")), frame(spark, (1, "b", "A"), (2, "b", "A"))
    held = effects.held_before(entry_of(kind), batch, name)
    found = effects.expected(entry_of(kind), batch, name, held)
    assert shape(found).count(" Window (") == windows
    assert "to_json" not in plan(found)
    assert [r.asDict() for r in found.select("Entity", "pulled", "inserted", "updated", "rows").collect()] == [
        {"Entity": "A", "pulled": 2, "inserted": 1, "updated": 1, "rows": 2}]


@pytest.mark.parametrize("kind", [catalog.REPLACE_LAST, catalog.REPLACE_ALL])
def test_rows_held_before_are_not_looked_for_again(spark, rows, kind):
    held = frame(spark, (1, "a", "A"), (2, "a", "A")).drop("page_no", "pos")
    batch = frame(spark, (2, "b", "A"), (1, "b", "A"), (3, "b", "A"))
    after = effects.change_of(entry_of(kind), True)(held, batch)
    assert rows(after) == rows(effects.change_of(entry_of(kind))(held, batch)) == [(i, "b", "A") for i in (1, 2, 3)]
    assert "Join" not in plan(after)


def test_digest_tells_nulls_columns_and_signs_apart(spark):
    made_of = [(None, "a", 0.0), ("a", None, 0.0), ("a", "", 0.0), ("a", None, -0.0), ("a", None, None), ("a", None, float("nan"))]
    df = spark.createDataFrame([(*r, [r[0]]) for r in made_of], "x STRING, y STRING, z DOUBLE, l ARRAY<STRING>")
    told = [r[0] for r in df.select(effects._digest(df.schema)).collect()]
    assert len(set(told)) == len(told)
    turned = df.select("l", "z", "y", "x")
    assert [r[0] for r in turned.select(effects._digest(turned.schema)).collect()] == told


def test_pages_are_numbered_without_their_records(spark, monkeypatch):
    """Numbers and links come from pages alone; a company's records don't go through one task."""
    kept, store = {}, loading.written_once
    monkeypatch.setattr(loading, "written_once", lambda df, purpose: kept.setdefault(purpose, shape(df)) and store(df, purpose))
    frame = spark.range(3000).selectExpr("id AS entryNo", "'s' AS status", "1D AS total", "IF(id < 3, 'B', 'A') AS Entity")
    landed = spark.read.json(loading._land(frame, ["x", None]))
    assert "collect_list" not in kept["numbers"]
    found = landed.select("Entity", "page_no", F.col("`@odata.nextLink`").isNotNull().alias("more"), F.explode("value").alias("r"))
    per = {r["Entity"]: r.asDict() for r in found.groupBy("Entity").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("r.entryNo", "r.status").alias("d"), F.max("page_no").alias("pages"),
        F.count_distinct("page_no").alias("numbers"), F.max(F.when(~F.col("more"), F.col("page_no"))).alias("end")).collect()}
    assert per["A"] == {"Entity": "A", "n": 5994, "d": 5994, "pages": 6, "numbers": 6, "end": 6}
    assert (per["B"]["n"], per["B"]["d"]) == (6, 6) and per["B"]["pages"] == per["B"]["numbers"] == per["B"]["end"]


def test_texts_fit_without_being_cast(spark, rows):
    """Every landed value has a text, so only values of other types are tried."""
    from ledgerhub.sources import pages

    found = spark.sql("""SELECT * FROM VALUES ('a', parse_json('"x"')), ('a', parse_json('[1]')), ('a', parse_json('{}')),
        ('a', parse_json('null')), ('b', parse_json('"x"')), ('b', parse_json('7')) AS t(column, value)""")
    counts = pages.field_counts(found, T.StructType().add("a", "string").add("b", "long"))
    assert rows(counts) == [("a", 3, 0), ("b", 2, 1)]
    only = pages.field_counts(found, T.StructType().add("a", "string"))
    assert "variant_get" not in plan(only) and rows(only) == [("a", 3, 0), ("b", 2, 0)]
