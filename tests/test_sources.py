"""Readers and binding."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from ledgerhub.operators import binding, changes
from ledgerhub.plans import extract
from ledgerhub.scratch import run_folder, shared_folder
from ledgerhub.sources import counts, pages, registry, reports

RECORD = T.StructType().add("no", "string").add("name", "string")


def land(folder, company, number, values, link, one_per_line=True):
    place = folder / f"Entity={company}"
    place.mkdir(exist_ok=True)
    page = {"value": values}
    if link:
        page["@odata.nextLink"] = link
    (place / f"page-{number:04d}.json").write_text(json.dumps(page, indent=None if one_per_line else 2))


@pytest.mark.parametrize("one_per_line", [True, False])
def test_page_chains(spark, rows, tmp_path, one_per_line):
    def put(*page):
        land(tmp_path, *page, one_per_line)

    put("A", 1, [{"no": "1", "name": "x"}, {"no": "2"}], "next")
    put("A", 2, [{"no": "3", "foo": 1}], None)
    put("B", 1, [{"no": "9"}], "next")
    put("C", 1, [{"no": "7"}], "next")
    put("C", 3, [{"no": "8"}], None)
    put("D", 1, [{"no": "5"}], "next")
    put("D", 2, [], "never followed")
    put("E", 2, [{"no": "6"}], None)
    put("F", 1, [{"no": "4"}], "next")
    put("F", 2, [{"no": "4"}], None)
    (tmp_path / "Entity=F" / "page-0002.json").write_text('{"value": [{"no": "4"')
    landed = pages.read_pages(spark, str(tmp_path), RECORD, one_per_line)
    status = pages.chain_status(landed)
    assert rows(status.where("complete"), "Entity") == [("A",), ("D",)]
    assert rows(pages.incomplete_companies(status)) == [("B", 1), ("C", 2), ("E", 1), ("F", 2)]
    kept, rejected = extract.landed_records(landed, store=one_per_line)
    assert rows(rejected) == rows(pages.incomplete_companies(status))
    assert rows(kept) == [
        ("A", 1, 0, "1", "x"), ("A", 1, 1, "2", None), ("A", 2, 0, "3", None), ("D", 1, 0, "5", None),
    ]


def test_count_answers(spark, rows, tmp_path):
    for company, text in (("A", "﻿ 123 "), ("B", "abc")):
        (tmp_path / f"Entity={company}").mkdir()
        (tmp_path / f"Entity={company}" / "answer.txt").write_text(text, encoding="utf-8")
    assert rows(counts.read_counts(spark, str(tmp_path))) == [("A", 123), ("B", None)]


def test_positional_report(spark, rows, tmp_path):
    (tmp_path / "r.csv").write_text('a,b,c\n1,"x, ""y""",\n2,"two\nlines",z\n')
    frame = reports.positional_report(spark, str(tmp_path), 3, quoted_newlines=True)
    assert rows(frame) == [("1", 'x, "y"', None), ("2", "two\nlines", "z")]


def test_positional_report_refuses_another_width(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        reports.positional_report(spark, str(tmp_path), 2).collect()


def test_widest_report_schema():
    assert [f.name for f in reports.positional_schema(300)][-1] == "_c300"


def test_named_report(spark, rows, tmp_path):
    (tmp_path / "r.csv").write_text("b;a\n1;x\n")
    assert rows(reports.named_report(spark, str(tmp_path), ";"), "a", "b") == [("x", "1")]


def test_bind_by_name(spark, rows):
    landed = spark.createDataFrame(
        [("7", "2024-13-01", "x", 1), ("no number", "2024-05-01", "y", 2)],
        "`[No]` STRING, DATE STRING, `@odata.etag` STRING, foo INT",
    )
    schema = (
        T.StructType().add("no", "long").add("Date", "date").add("name", "string").add("etag", "string")
    )
    bound = binding.bind(landed, schema)
    assert bound.schema == schema
    assert rows(bound.selectExpr("no", "cast(Date as string)", "name", "etag")) == [
        (7, None, None, "x"), (None, "2024-05-01", None, "y"),
    ]
    assert binding.drift(landed, schema) == {"missing": ["name"], "unknown": ["foo"]}


def test_small_bindings(spark, rows):
    frame = spark.createDataFrame([(1, "x", "t")], "a INT, b STRING, `[@odata.etag]` STRING")
    assert binding.without(frame, ["@odata.etag"]).columns == ["a", "b"]
    assert binding.tagged(frame, "A").columns[-1] == "Entity"
    with pytest.raises(ValueError):
        binding.positional(frame, ["one"])
    good, bad = binding.split_required(
        spark.createDataFrame([("NL", "N"), (None, "X")], "code STRING, displayName STRING"), ["code", "displayName"]
    )
    assert rows(good) == [("NL", "N")] and rows(bad) == [(None, "X")]


def test_registry(spark, rows):
    spark.createDataFrame([("Consol HV",), ("Other",)], "name STRING").createOrReplaceTempView("companies2")
    assert rows(registry.read_companies(spark, "companies2")) == [("Consol HV",), ("Other",)]
    assert rows(registry.read_companies(spark, "companies2", skip=["Consol HV "])) == [("Consol HV",), ("Other",)]
    trimmed = registry.read_companies(spark, "companies2", skip=["Consol HV "], ignore_trailing_blanks=True)
    assert rows(trimmed) == [("Other",)]
    data = spark.createDataFrame([("Other", 1), ("Else", 2)], "Entity STRING, v INT")
    assert rows(registry.for_companies(data, trimmed)) == [("Other", 1)]


def test_change_filters(spark, rows):
    frame = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP '2024-05-01 00:00:00', 'Cost'), (2, TIMESTAMP '2024-05-01 00:00:01', 'Item'),"
        " (3, TIMESTAMP '2024-05-02 09:00:00', 'Service') t(id, at, type)"
    )
    assert rows(changes.modified_since(frame, "at", "2024-05-02"), "id") == [(2,), (3,)]
    assert rows(changes.modified_after(frame, "at", "2024-05-02 00:00:00"), "id") == [(3,)]
    assert rows(changes.of_kinds(frame, "type", ["Cost", "Service"]), "id") == [(1,), (3,)]
    assert rows(frame.where(changes.created_on(frame["at"], "2024-05-01")), "id") == [(1,), (2,)]


def test_shared_folder_without_setting():
    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = {}, SimpleNamespace(master=master)

    assert shared_folder(Session("local[2]")) == shared_folder(Session("local[2]"))
    with pytest.raises(RuntimeError):
        shared_folder(Session("yarn"))


def test_run_folder_is_below_the_shared_folder(spark):
    first, second = run_folder(spark, "x"), run_folder(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
