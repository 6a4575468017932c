"""Column types from landed values, runs of jobs without declared columns, one parse of the pages."""

import json
import uuid

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerhub.operators import inference
from ledgerhub.plans import catalog, extract, schemas
from ledgerhub.scratch import run_folder
from ledgerhub.sinks import tables
from ledgerhub.sources import pages


def landed(spark, tmp_path, records, entity="A", extra=""):
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / "p.json").write_text('{"Entity": "%s", "page_no": 1, "value": [%s]%s}' % (entity, ", ".join(texts), extra))
    return str(folder)


def types(spark, tmp_path, records):
    folder = landed(spark, tmp_path, records)
    found = inference.typed(inference.profile(pages.fields(pages.read_pages(spark, folder, pages.RAW))))
    return {r["column"]: (r["type"], r["filled"]) for r in found.collect()}


KINDS = {  # JSON values and the type that holds them all
    "null": (["null"], "string"), "flag": (["true", "null", "false"], "boolean"), "number": (["1", "-20", "0"], "bigint"),
    "decimal": (["1", "-2.5", "null"], "decimal(18,2)"), "fine": (["0.123456", "12345678901234"], "decimal(20,6)"),
    "huge": (["1234567890123456789"], "decimal(21,2)"), "float": (["1", "2.5", "3.5E300"], "double"),
    "day": (['"2024-02-29"', "null"], "date"), "time": (['"2024-02-29"', '"2024-05-01T10:00:00Z"', '"2024-05-01T10:00:00.123+02:00"'], "timestamp"),
    "code": (['"0012"', '"12"'], "string"), "no day": (['"2023-02-29"'], "string"), "empty": (['""', '"2024-01-01"'], "string"),
    "flag or number": (["true", "1"], "string"), "number or day": (["1", '"2024-01-01"'], "string"),
    "quoted number": (["1", '"1"'], "string"), "object": (['{"a": 1}'], "string"), "list": (["[1]", "1"], "string"),
    "too wide": (["1" * 38, "0.12345"], "string"), "1 or flag or float": (["1.5E2", "true"], "string"),
}


def test_kinds(spark, tmp_path):
    records = []
    for name, (values, _) in KINDS.items():
        records += ['{"%s": %s}' % (name, v) for v in values]
    got = types(spark, tmp_path, records)
    assert {n: t for n, (t, _) in got.items()} == {n: t for n, (_, t) in KINDS.items()}
    assert got["null"][1] == 0 and got["flag"][1] == 2 and got["time"][1] == 3


VALUES = [v for values, _ in KINDS.values() for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(VALUES), st.integers(0, 2)), min_size=1, max_size=30))
def test_profiles_merge_in_any_order(spark, values):
    """Facts of parts, merged in either order, are those of all rows: the aggregate is a monoid."""
    df = spark.createDataFrame(values, "column string, text string, part int").select(
        "column", F.try_parse_json("text").alias("value"), "part")
    whole = sorted(inference.profile(df.drop("part")).collect())
    parts = [inference.profile(df.where(F.col("part") == i).drop("part")) for i in range(3)]
    assert sorted(inference.merged(parts).collect()) == whole
    assert sorted(inference.merged([inference.merged(parts[::2]), parts[1]]).collect()) == whole


def test_schema(spark):
    def profile(*rows):
        fields = spark.createDataFrame(rows, "column string, text string").select("column", F.try_parse_json("text").alias("value"))
        return inference.profile(fields)

    odd = profile(("No", "1"), ("no", "1"), ("no", "2"), ("ENTITY", '"x"'), ("page_no", "1"), ("@odata.etag", '"t"'), ("it's", "true"))
    found = inference.schema(odd, ["Entity", "page_no", "pos"])
    assert [(f.name, f.dataType.simpleString()) for f in found.fields] == [
        ("@odata.etag", "string"), ("it's", "boolean"), ("no", "bigint")]
    with pytest.raises(ValueError, match="more than 2 field names"):
        inference.schema(odd, max_columns=2)
    assert len(inference.schema(profile(("a", "1")).limit(0))) == 0


def test_one_hot_column_is_added_up_before_the_shuffle(spark):
    from tests.plans_text import exchanges, plan

    df = spark.range(100).selectExpr("'a' AS column", "parse_json(cast(id as string)) AS value")
    out = inference.profile(df)
    assert exchanges(out) == 1 and "partial_count" in plan(out)


def test_every_job_of_the_catalog_runs():
    """39 jobs: 18 with declared columns, 6 by position, 15 by inference, all of them whole refreshes."""
    declared = {d.target for d in catalog.DATASETS if schemas.schema_of(d.target) is not None}
    positional = {d.target for d in catalog.DATASETS if d.width is not None}
    others = [d for d in catalog.DATASETS if d.target not in declared | positional]
    assert (len(declared), len(positional), len(others)) == (18, 6, 15)
    assert {d.load for d in others} == {catalog.REFRESH, catalog.STAGED_REFRESH}
    assert len(catalog.DATASETS) == 39


@pytest.mark.parametrize("target", ["BC_Services", "BC_Customers_wide", "BC_wmsRecordLink2"])
def test_runs_without_declared_columns(spark, rows, tmp_path, target):
    entry, name, log, store = catalog.dataset(target), f"t_{uuid.uuid4().hex}", run_folder(spark, "log"), run_folder(spark, "table")

    def run(records, extra=""):
        folder = landed(spark, tmp_path, records, extra=extra)
        return extract.run_inferred(spark, entry, folder, name, "2024-05-02", log, store)

    rejects, drift = run([{"Table_ID": 122, "no": "1"}], ', "@odata.nextLink": "more"')
    assert rows(rejects) == [("A", 1)] and rows(drift) == [] and not spark.catalog.tableExists(name)  # nothing landed whole
    first = [{"@odata.etag": "e", "Table_ID": 122, "no": "007", "day": "2024-05-01", "Entity": "odd", "empty": None},
             {"@odata.etag": "e", "Table_ID": 9, "no": "8", "day": None}]
    _, drift = run(first)
    assert rows(drift) == [("unknown", "Entity", 1)]
    expected = [(122, "007", "A", None), (9, "8", "A", None)]
    kept = [r for r in expected if not entry.kinds or r[0] == 122]
    assert rows(spark.table(name), "Table_ID", "no", "Entity", "empty") == sorted(kept, key=repr)
    assert ("@odata.etag" in spark.table(name).columns) == (not entry.skipped)
    assert dict(spark.table(name).dtypes)["day"] == "date"
    _, drift = run([{"Table_ID": 122, "no": "9", "day": "soon", "more": 1, "@odata.etag": "e"}])
    found = rows(drift)
    assert {("unfit", "day", 1), ("unknown", "more", 1), ("missing", "empty", 0)} <= set(found)
    assert rows(spark.table(name), "Table_ID", "no", "day") == [(122, "9", None)]


def test_pages_are_parsed_once(spark, tmp_path, monkeypatch):
    reads = []
    original = pages.read_pages
    monkeypatch.setattr(pages, "read_pages", lambda *a, **k: reads.append(a[1]) or original(*a, **k))
    entry, name = catalog.dataset("BC_wmsRecordLink"), f"t_{uuid.uuid4().hex}"
    schema = spark.createDataFrame([], "id STRING, tableNo INT, created TIMESTAMP, Entity STRING").schema
    tables.create(spark, name, schema, run_folder(spark, "test"))
    folder = landed(spark, tmp_path, [{"id": "1", "tableNo": "x", "created": "2024-05-02T10:00:00Z"}, {"id": "2", "tableNo": 0, "created": "2024-05-02T10:00:00Z"}])
    _, drift = extract.run_landed(spark, entry, folder, name, "2024-05-02", run_folder(spark, "log"))
    assert len(reads) == 1
    assert [tuple(r) for r in drift.collect()] == [("unfit", "tableNo", 1)]
    assert [r["id"] for r in spark.table(name).collect()] == ["2"]
