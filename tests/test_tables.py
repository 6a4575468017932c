"""Stored tables, the extract catalog and streams."""

import uuid
from datetime import datetime, timedelta

import pytest

from ledgerhub.operators.load import upsert
from ledgerhub.plans import catalog, extract
from ledgerhub.scratch import run_folder, written_once
from ledgerhub.sinks import files, tables
from ledgerhub.streaming.inbox import inbox_stream
from ledgerhub.streaming.stuck import watch
from ledgerhub.streaming.upserts import upsert_stream

DDL = "id INT, v STRING, Entity STRING"
KEYS = ["id", "Entity"]


@pytest.fixture
def table(spark):
    def made(df):
        name = f"t_{uuid.uuid4().hex}"
        tables.create(spark, name, df.schema, run_folder(spark, "test"))
        return name

    return made


def test_company_table(spark, rows, table):
    odd = "O'Brien: 50% B/V"
    first = spark.createDataFrame([(1, "a", "A b"), (2, "b", odd), (3, "c", "C")], DDL)
    name = table(first)
    tables.refresh(first, name)
    assert rows(spark.table(name)) == rows(first)
    batch = spark.createDataFrame([(2, "new", odd), (9, "add", "D"), (4, "more", "C")], DDL)
    touched = tables.change_companies(batch, name, KEYS, lambda t, b: upsert(t, b, KEYS))
    assert touched == ([odd], ["C", "D"])
    assert rows(spark.table(name)) == [
        (1, "a", "A b"), (2, "new", odd), (3, "c", "C"), (4, "more", "C"), (9, "add", "D"),
    ]
    tables.append(spark.createDataFrame([(7, "x", odd)], DDL), name)
    assert rows(spark.table(name).where("id in (2, 7)")) == [(2, "new", odd), (7, "x", odd)]
    tables.refresh(first.where("id = 1"), name)
    assert rows(spark.table(name)) == [(1, "a", "A b")]


def test_refresh_drops_only_what_is_known_to_be_gone(spark, rows, table):
    first = spark.createDataFrame([(i, "a", c) for i, c in enumerate("ABCD")], DDL)
    batch = spark.createDataFrame([(9, "b", "A")], DDL)
    complete = spark.createDataFrame([("A",), ("B",)], "Entity STRING")
    registered = spark.createDataFrame([("A",), ("B",), ("C",)], "Entity STRING")
    for known, left in [((None, None), "ABCD"), ((complete, None), "ACD"), ((None, registered), "ABC"), ((complete, registered), "AC")]:
        name = table(first)
        tables.refresh(first, name)
        tables.refresh_companies(batch, name, *known)
        assert [r[0] for r in rows(spark.table(name), "Entity")] == list(left)
        assert rows(spark.table(name).where("Entity = 'A'")) == [(9, "b", "A")]


@pytest.mark.parametrize("companies", [5, 300])
def test_number_of_companies_changes_nothing(spark, rows, table, companies):
    first = spark.createDataFrame([(i, "a", f"c{i % companies}") for i in range(2 * companies)], DDL)
    batch = spark.createDataFrame([(i, "b", f"c{i % companies}") for i in range(companies, 2 * companies + 3)], DDL)
    name = table(first)
    tables.refresh(first, name)
    change = lambda t, b: upsert(t, b, KEYS)
    expected = rows(change(first, batch))
    hit, fresh = tables.change_companies(batch, name, KEYS, change)
    assert len(hit) == companies and fresh == []
    assert rows(spark.table(name)) == expected


def test_thousands_of_companies_with_buckets(spark, rows):
    """The filter on touched partitions is one look-up: 5,000 companies of 4 buckets, and a change of 700."""
    layout = tables.Layout("Entity", ("id",), 4)
    specs = [(f"O'Neil \\ {i}/{i % 7}", str(b)) for i in range(5000) for b in range(4)]
    frame = spark.createDataFrame([*[(c, int(b)) for c, b in specs[::9]], ("O'Neil \\ 1/1", 9), ("x", 1)], "Entity STRING, _bucket INT")
    assert frame.where(layout.within(specs)).count() == len(specs[::9])
    assert frame.where(layout.within([])).count() == 0
    first = spark.range(700).selectExpr("CAST(id AS INT) AS id", "'a' AS v", "concat('c', id) AS Entity")
    name = f"t_{uuid.uuid4().hex}"
    tables.create(spark, name, first.schema, run_folder(spark, "test"), keys=["id"], buckets=4)
    change = lambda t, b: upsert(t, b, KEYS, measured=True)
    assert tables.change_companies(first, name, KEYS, change) == ([], sorted(f"c{i}" for i in range(700)))
    batch = spark.createDataFrame([(3, "new", "c3"), (900, "new", "c4")], DDL)
    assert tables.change_companies(batch, name, KEYS, change)[0] == ["c3"]
    assert rows(spark.table(name).where("v = 'new'"), "id", "Entity") == [(3, "c3"), (900, "c4")]
    assert spark.table(name).count() == 701


def test_a_company_with_most_rows_becomes_many_files(spark, table):
    rows_in = spark.range(0, 200_000, 1, 8).selectExpr(
        "CAST(id AS INT) AS id", "md5(CAST(id AS STRING)) AS v", "IF(id % 10 < 7, 'hot', concat('c', id % 10)) AS Entity"
    )
    name = table(rows_in)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tables.refresh(rows_in, name)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stored = spark.table(name)
    files_of = stored.selectExpr("Entity", "_metadata.file_path AS f").distinct().groupBy("Entity").count()
    files = {r["Entity"]: r["count"] for r in files_of.collect()}
    assert stored.count() == 200_000
    assert files["hot"] > 2 and max(n for c, n in files.items() if c != "hot") <= 2


def folder_bytes(folder):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("buckets", [1, 16])
def test_a_changed_row_rewrites_its_bucket_and_bytes_do_not_grow(spark, rows, buckets):
    first = spark.range(20_000).selectExpr("CAST(id AS INT) AS id", "md5(CAST(id AS STRING)) AS v", "IF(id < 18000, 'big', 'small') AS Entity")
    name, folder = f"t_{uuid.uuid4().hex}", run_folder(spark, "test")
    tables.create(spark, name, first.schema, folder, keys=["id"], buckets=buckets)
    tables.refresh(first, name)
    size, old = folder_bytes(folder), {r[0] for r in spark.table(name).selectExpr("_metadata.file_path").distinct().collect()}
    for run in range(10):
        batch = spark.createDataFrame([(7, f"run {run}", "big")], DDL)
        tables.change_companies(batch, name, KEYS, lambda t, b: upsert(t, b, KEYS, measured=True))
        if run == 0:
            new = spark.table(name).selectExpr("_metadata.file_path AS p", "id").where(f"p not in ({', '.join(repr(o) for o in old)})")
            assert new.count() < (18_000 if buckets == 1 else 18_000 / buckets * 1.5) + 1
    assert rows(spark.table(name).where("id = 7"), "id", "v", "Entity") == [(7, "run 9", "big")]
    assert spark.table(name).count() == 20_000
    assert folder_bytes(folder) < 1.3 * size


def test_bucketed_table_equals_plain_one(spark, rows):
    first = spark.createDataFrame([(i, "a", f"c{i % 3}") for i in range(60)], DDL)
    batch = spark.createDataFrame([(i, "b", f"c{i % 4}") for i in range(40, 90)], DDL)
    frames = []
    for buckets in (1, 5):
        name = f"t_{uuid.uuid4().hex}"
        tables.create(spark, name, first.schema, run_folder(spark, "test"), keys=["id"], buckets=buckets)
        tables.refresh(first, name)
        tables.change_companies(batch, name, KEYS, lambda t, b: upsert(t, b, KEYS))
        tables.append(batch.where("id = 89").selectExpr("id + 100 AS id", "v", "Entity"), name)
        tables.refresh_companies(first.where("Entity = 'c0' and id < 9"), name)
        frames.append(rows(spark.table(name), "id", "v", "Entity"))
    assert frames[0] == frames[1] and len(frames[0]) > 40
    with pytest.raises(ValueError, match="buckets by id"):
        tables.change_companies(batch, name, ["Entity"], lambda t, b: b)


def test_failed_change_leaves_the_table_alone(spark, rows, table):
    first = spark.createDataFrame([(1, "a", "A")], DDL)
    name = table(first)
    tables.refresh(first, name)
    twice = spark.createDataFrame([(1, "b", "A"), (1, "c", "A")], DDL)
    with pytest.raises(Exception, match="repeats key"):
        tables.change_companies(twice, name, KEYS, lambda t, b: upsert(t, b, KEYS))
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name)) == [(1, "a", "A")]


def test_rows_without_company_are_refused(spark, table):
    frame = spark.createDataFrame([(1, "a", None)], DDL)
    with pytest.raises(ValueError):
        tables.change_companies(frame, table(frame), KEYS, lambda t, b: b)
    with pytest.raises(ValueError):
        tables.refresh(frame, table(frame))


def test_plain_table_swap(spark, rows):
    frame = spark.createDataFrame([(1, "x")], "id INT, Location STRING")
    name = f"t_{uuid.uuid4().hex}"
    tables.create_plain(spark, name, frame.schema, run_folder(spark, "test"))
    assert spark.table(name).count() == 0
    for version in (frame, frame.selectExpr("id + 1 AS id", "Location")):
        tables.swap(version, name)
        assert rows(spark.table(name)) == rows(version)


def test_logged_run(spark, rows, table):
    frame = spark.createDataFrame([landed_row(1, "a", 0), landed_row(2, "b", 1)], LANDED)
    name, log = table(frame.drop("page_no", "pos")), run_folder(spark, "log")
    entry = catalog.dataset("BC_CustomerLedgerEntries")
    extract.logged_run(entry, frame, name, "2024-05-02", log)
    extract.logged_run(entry, frame, name, "2024-05-02", log)
    with pytest.raises(Exception, match="nosuch"):
        extract.logged_run(entry, frame, "nosuch", "2024-05-02", log)
    logged = rows(spark.read.parquet(log), "Name", "Status", "RecordsInserted", "company_name")
    # the second run pulls nothing, so it has no company to tell of
    assert logged == sorted([
        ("BC_CustomerLedgerEntries", "Success", 2, "A"), ("BC_CustomerLedgerEntries", "Error", None, "A"),
    ], key=repr)


def test_logged_refresh_checks_what_it_finds(spark, rows, table):
    frame = spark.createDataFrame([landed_row(1, "a", 0), landed_row(2, "b", 1, entity="B")], LANDED)
    name, log = table(frame.drop("page_no", "pos")), run_folder(spark, "log")
    extract.logged_run(catalog.dataset("BC_Customers"), frame, name, "2024-05-02", log)
    logged = rows(spark.read.parquet(log), "Status", "RecordsInserted", "company_name", "error_details")
    assert logged == [("Success", 1, "A", "Total rows inserted: 1."), ("Success", 1, "B", "Total rows inserted: 1.")]


def test_error_without_text_is_logged(spark, rows, table, monkeypatch):
    frame = spark.createDataFrame([landed_row(1, "a", 0)], LANDED)
    name, log = table(frame.drop("page_no", "pos")), run_folder(spark, "log")

    def fails(*_):
        raise RuntimeError()

    monkeypatch.setattr(extract, "apply", fails)
    with pytest.raises(RuntimeError):
        extract.logged_run(catalog.dataset("BC_Customers"), frame, name, "2024-05-02", log)
    assert rows(spark.read.parquet(log), "Status", "error_details") == [("Error", "RuntimeError")]


def test_catalog_is_whole():
    assert len(catalog.DATASETS) == 39
    assert len({d.target for d in catalog.DATASETS}) == 39
    loads = [d.load for d in catalog.DATASETS]
    assert loads.count(catalog.APPEND) == 6 and loads.count(catalog.REPORT) == 6
    assert loads.count(catalog.REPLACE_LAST) == 5 and loads.count(catalog.REPLACE_ALL) == 1
    assert [d.width for d in catalog.DATASETS if d.load == catalog.REPORT] == [154, 62, 300, 76, 208, 6]


LANDED = (
    "id INT, no INT, entryNo INT, type STRING, tableNo INT, Table_ID INT, v STRING, systemModifiedAt DATE,"
    " created DATE, Entity STRING, page_no INT, pos INT"
)
COLUMNS = LANDED.split(", page_no")[0]


def landed_row(key, v, pos, kind="Cost", table_no=122, day="2024-05-02", entity="A"):
    from datetime import date

    when = date.fromisoformat(day)
    return (key, key, key, kind, table_no, table_no, v, when, when, entity, 1, pos)


@pytest.mark.parametrize("target, expected", [
    ("BC_Customers", [(1, "b"), (1, "c"), (2, "x"), (3, "old day"), (4, "item"), (9, "z")]),
    ("BC_CustomerLedgerEntries", [(1, "a"), (2, "x"), (3, "old day"), (4, "item"), (9, "z")]),
    ("BC_PurchaseInvoiceHeader", [(1, "b"), (1, "c"), (2, "x"), (4, "item"), (9, "z")]),
    ("BC_SalesInvoiceHeader", [(1, "c"), (2, "x"), (4, "item"), (9, "z")]),
    ("BC_wmsDL", [(1, "c"), (2, "x"), (9, "z")]),
    ("BC_wmsRecordLink2", [(1, "b"), (1, "c"), (2, "x"), (3, "old day"), (9, "z")]),
])
def test_stored_runs_equal_pure_loads(spark, rows, table, target, expected):
    landed = spark.createDataFrame([
        landed_row(1, "b", 0), landed_row(1, "c", 1), landed_row(2, "x", 2),
        landed_row(3, "old day", 3, day="2024-04-01"), landed_row(4, "item", 4, kind="Item", table_no=5),
    ], LANDED)
    before = spark.createDataFrame([landed_row(1, "a", 0)[:-2], landed_row(9, "z", 0, entity="B")[:-2]], COLUMNS)
    entry = catalog.dataset(target)
    if entry.entry_no:
        landed = landed.where("v not in ('b', 'c')")
    name = table(before)
    tables.refresh(before, name)
    pure = extract.loaded(entry, before, landed, "2024-05-02")
    if entry.load in extract.REFRESHES:  # the pure load has the companies that landed
        pure = pure.unionByName(before.where("Entity = 'B'"))
    assert rows(pure, "id", "v") == expected
    extract.run(entry, landed, name, "2024-05-02")
    assert rows(spark.table(name), "id", "v") == expected


def test_merge_runs(spark, rows, table):
    landed = spark.createDataFrame([
        landed_row(1, "b", 0), landed_row(2, "x", 1), landed_row(3, "other table", 2, table_no=5),
    ], LANDED)
    before = spark.createDataFrame([landed_row(1, "a", 0)[:-2]], COLUMNS)
    for target, expected in [
        ("BC_wmsRecordLink", [(1, "b"), (2, "x")]),
        ("BC_GLentries", [(1, "a"), (2, "x"), (3, "other table")]),
    ]:
        name = table(before)
        tables.refresh(before, name)
        extract.run(catalog.dataset(target), landed, name, "2024-05-02")
        assert rows(spark.table(name), "id", "v") == expected


def test_stream_upsert_continues_from_its_checkpoint(spark, rows, table, tmp_path):
    first = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], DDL)
    name, landing, checkpoint = table(first), str(tmp_path / "in"), str(tmp_path / "cp")

    def poll():
        upsert_stream(spark, landing, first.schema, name, ["id", "Entity"], checkpoint, 10).awaitTermination()

    first.write.parquet(landing)
    poll()
    spark.createDataFrame([(2, "new", "B"), (3, "c", "C")], DDL).write.mode("append").parquet(landing)
    poll()
    poll()
    assert rows(spark.table(name)) == [(1, "a", "A"), (2, "new", "B"), (3, "c", "C")]


def test_overlapping_polls_and_rows_without_key(spark, rows, table, tmp_path):
    """Two polls land one key before a run; the last arrival wins, and a restart changes nothing."""
    first = spark.createDataFrame([(1, "a", "A"), (2, "b", "B"), (None, "no key", "A")], DDL)
    name, landing, checkpoint, aside = table(first), str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "aside")

    def poll(**more):
        upsert_stream(spark, landing, first.schema, name, ["id", "Entity"], checkpoint, **more).awaitTermination()

    first.coalesce(1).write.parquet(landing)
    spark.createDataFrame([(1, "newer", "A")], DDL).write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="cannot be stored"):
        poll()
    for _ in range(2):
        poll(rejects=aside)
        assert rows(spark.table(name)) == [(1, "newer", "A"), (2, "b", "B")]
        assert rows(spark.read.parquet(aside), "v") == [("no key",)]


def test_replayed_batch_with_null_key_adds_nothing(spark, rows, table, tmp_path):
    batch = spark.createDataFrame([(1, "a", "A"), (None, "x", "A")], DDL)
    name = table(batch)
    for _ in range(2):
        tables.change_companies(batch, name, KEYS, lambda t, b: upsert(t, b, KEYS), rejects=str(tmp_path / "aside"))
    assert rows(spark.table(name)) == [(1, "a", "A")]
    assert rows(spark.read.parquet(str(tmp_path / "aside"))) == [(None, "x", "A")]


def test_messages_turn_stuck_while_nothing_lands(spark, rows, table, tmp_path):
    ddl = "id INT, status STRING, messageType STRING, receivedAt TIMESTAMP_NTZ, Entity STRING"
    when = datetime(2024, 1, 1, 12, 0)
    first = spark.createDataFrame([(1, "New", "CDM", when, "A"), (2, "New", "CDM", when, "A")], ddl)
    name, places = table(first), [str(tmp_path / p) for p in ("in", "cp", "alerts")]

    def check(minutes):
        found = watch(spark, places[0], first.schema, name, ["id", "Entity"], places[1], places[2], "http://x?c=",
                      when + timedelta(minutes=minutes))
        return rows(found, "company_name", "row_count")

    first.write.parquet(places[0])
    assert check(1) == []
    assert check(60) == [("A", 2)]
    spark.createDataFrame([(1, "Done", "CDM", when, "A")], ddl).write.mode("append").parquet(places[0])
    assert check(61) == [("A", 1)]


def test_inbox_sets_malformed_messages_aside(spark, rows, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    messages = ["<m>\n<id>1</id>\n<t>a &amp; b</t></m>", "<m><id>2</m>", "plain", "<m><id>4</id></m>"]
    for i, message in enumerate(messages):
        (inbox / f"{i}.xml").write_text(message)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    inbox_stream(spark, str(inbox), "id STRING, t STRING", good, bad, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(good), "id", "t") == [("1", "a & b"), ("4", None)]
    assert rows(spark.read.parquet(bad), "payload") == [("<m><id>2</m>",), ("plain",)]


def test_files(spark, rows, tmp_path):
    frame = spark.createDataFrame([(1, 'x "q", y', "A b")], DDL)
    files.write_report(frame, str(tmp_path / "r"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "r"))
    assert rows(back, "id", "v", "Entity") == [("1", 'x "q", y', "A b")]
    assert rows(written_once(frame, "test")) == rows(frame)


def test_declared_columns(spark, tmp_path):
    from ledgerhub.plans import schemas

    targets = {d.target for d in catalog.DATASETS}
    known = [d.target for d in catalog.DATASETS if schemas.schema_of(d.target) is not None]
    assert set(known) <= targets and len(known) == 18
    assert extract.declared(catalog.dataset("BC_wmsRecordLink")).fieldNames() == ["id", "tableNo", "created"]
    with pytest.raises(ValueError, match="no columns are declared"):
        extract.declared(catalog.dataset("BC_Services"))


def test_one_path_from_landing_to_table(spark, rows, tmp_path):
    """Text values become typed, unknown fields are reported, an unfinished pull is rejected and kept."""
    entry, log = catalog.dataset("BC_wmsRecordLink"), run_folder(spark, "log")
    name = f"t_{uuid.uuid4().hex}"
    stored = "id STRING, tableNo INT, created TIMESTAMP, Entity STRING"
    tables.create(spark, name, spark.createDataFrame([], stored).schema, run_folder(spark, "test"), keys=["id"], buckets=2)
    wide = spark.createDataFrame([], "id STRING, tableNo STRING, created STRING, extra STRING").schema

    def land(lines):
        folder = tmp_path / uuid.uuid4().hex
        folder.mkdir()
        (folder / "pages.json").write_text("\n".join(lines))
        return extract.run_landed(spark, entry, str(folder), name, "2024-05-02", log, landed=wide)

    record = '{"id": "%s", "tableNo": "%s", "created": "2024-05-02 10:00:00", "extra": "e"}'
    rejects, drift = land([
        '{"Entity": "A", "page_no": 1, "value": [%s, %s]}' % (record % ("1", "122"), record % ("2", "7")),
        '{"Entity": "B", "page_no": 1, "@odata.nextLink": "more", "value": [%s]}' % (record % ("3", "122")),
    ])
    assert rows(rejects) == [("B", 1)] and rows(drift) == [("unknown", "extra", 2)]
    assert rows(spark.table(name), "id", "tableNo", "Entity") == [("1", 122, "A")]
    assert rows(spark.read.parquet(log), "Status", "RecordsInserted", "company_name") == [("Success", 1, "A")]


def test_watermarks_are_kept_with_the_load(spark, rows, table):
    """The second run reads the kept marks; any other write makes the third scan the table."""
    entry = catalog.dataset("BC_CustomerLedgerEntries")
    frame = spark.createDataFrame([landed_row(1, "a", 0), landed_row(5, "b", 1), landed_row(2, "c", 2, entity="B")], LANDED)
    name = table(frame.drop("page_no", "pos"))
    assert tables.kept_marks(spark, name) is None
    extract.run(entry, frame, name, "2024-05-02")
    assert rows(tables.kept_marks(spark, name)) == [("A", 5), ("B", 2)]
    more = frame.unionByName(spark.createDataFrame([landed_row(9, "d", 3)], LANDED))
    extract.run(entry, more, name, "2024-05-02")
    assert rows(spark.table(name), "id") == [(1,), (2,), (5,), (9,)]
    assert rows(tables.kept_marks(spark, name)) == [("A", 9), ("B", 2)]
    tables.append(spark.createDataFrame([landed_row(20, "e", 4)], LANDED).drop("page_no", "pos"), name)
    assert tables.kept_marks(spark, name) is None
    late = spark.createDataFrame([landed_row(15, "too late", 5), landed_row(21, "f", 6)], LANDED)
    extract.run(entry, late, name, "2024-05-02")
    assert {r["id"] for r in spark.table(name).collect()} == {1, 2, 5, 9, 20, 21}


def test_watermarks_leave_one_folder(spark, table):
    import os

    entry = catalog.dataset("BC_CustomerLedgerEntries")
    rows_of = lambda n: spark.createDataFrame([landed_row(i, "a", i) for i in range(n)], LANDED)
    name = table(rows_of(1).drop("page_no", "pos"))
    for n in (3, 5, 7):
        extract.run(entry, rows_of(n), name, "2024-05-02")
        folder = tables._table_folder(spark, f"{name}_watermarks").removeprefix("file:")
        assert len(os.listdir(os.path.dirname(folder))) == 1
    assert tables.kept_marks(spark, name).collect()[0]["max_entry_no"] == 6


def test_all_columns_of_a_job_land(spark, rows, tmp_path):
    """Names as they land, the record tag among them: none is lost between page and table."""
    values = {"long": "7", "int": "7", "boolean": "true", "date": '"2024-05-02"', "timestamp": '"2024-05-02T10:00:00Z"',
              "string": '"122"', "decimal(18,2)": "1.25", "decimal(18,6)": "1.5", "bigint": "7"}
    sizes = {"BC_GLentries": 78, "BC_Customers": 28, "BC_wmsDH": 40, "BC_wmsDL": 32}
    names = {"BC_GLentries": "vatAmount", "BC_Customers": "displayName", "BC_wmsDH": "no", "BC_wmsDL": "lineAmountLCY"}
    for target, size in sizes.items():
        entry = catalog.dataset(target)
        wanted = extract.declared(entry)
        assert len(wanted) == size and names[target] in wanted.fieldNames()
        assert {k for k in (*entry.keys, entry.entry_no, entry.changed) if k and k != "Entity"} <= set(wanted.fieldNames())
        kept = {entry.kinds[0]: f'"{entry.kinds[1][0]}"'} if entry.kinds else {}
        record = ", ".join(f'"{f.name}": {kept.get(f.name, values[f.dataType.simpleString()])}' for f in wanted.fields)
        folder, name = tmp_path / target, f"t_{uuid.uuid4().hex}"
        folder.mkdir()
        (folder / "pages.json").write_text('{"Entity": "A", "page_no": 1, "value": [{%s}]}' % record)
        stored = spark.createDataFrame([], wanted).schema.add("Entity", "string")
        tables.create(spark, name, stored, run_folder(spark, "test"), keys=list(entry.keys[:1]), buckets=2 if entry.keys else 0)
        extract.run_landed(spark, entry, str(folder), name, "2024-05-02", run_folder(spark, "log"))
        found = spark.table(name).collect()
        assert len(found) == 1 and None not in found[0]


def test_drift_of_landed_pages_without_their_schema(spark, rows, tmp_path):
    """Fields the API adds, drops or spells anew are reported although pages are parsed by the declared names."""
    entry, name = catalog.dataset("BC_wmsRecordLink"), f"t_{uuid.uuid4().hex}"
    stored = "id STRING, tableNo INT, created TIMESTAMP, Entity STRING"
    tables.create(spark, name, spark.createDataFrame([], stored).schema, run_folder(spark, "test"), keys=["id"], buckets=2)

    def drift(*records):
        folder = tmp_path / uuid.uuid4().hex
        folder.mkdir()
        page = '{"Entity": "A", "page_no": 1, "value": [%s]}' % ", ".join(records)
        other = '{"Entity": "B", "page_no": 2, "value": [{"rejected": 1}]}'
        (folder / "pages.json").write_text(page + "\n" + other)
        return rows(extract.run_landed(spark, entry, str(folder), name, "2024-05-02", run_folder(spark, "log"))[1])

    whole = '"id": "1", "tableNo": 122, "created": null'
    assert drift() == [] and drift("{%s}" % whole) == []
    assert drift("{%s, \"new\": {\"a\": [1]}}" % whole, "{%s, \"new\": null, \"none\": null}" % whole) == [
        ("unknown", "new", 1), ("unknown", "none", 0)]
    assert drift('{"id": "1", "TableNo": 122}') == [
        ("missing", "created", 0), ("missing", "tableNo", 0), ("unknown", "TableNo", 1)]


def test_landed_pages_grow_in_number(spark):
    """A company with many rows lands in many pages of bounded size; its chain is whole."""
    from ledgerhub.sources import pages
    from ledgerhub.warehouse_queries import loading

    frame = spark.range(12000).selectExpr(
        "id AS entryNo", "'s' AS status", "1D AS total", "IF(id < 10, 'B', 'A') AS Entity")
    landing = pages.read_pages(spark, loading._land(frame, [None]), loading.RECORD)
    sizes = {(r["Entity"], r["page_no"]): len(r["value"]) for r in landing.collect()}
    assert sum(e == "A" for e, _ in sizes) == 12 and sum(sizes.values()) == 12000 and max(sizes.values()) <= 1.2 * loading.PAGE_ROWS
    assert pages.chain_status(landing).where("complete").count() == 2
