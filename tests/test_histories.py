"""Intervals of versions, merges by version, redelivered messages, windows to pull, XML files, against plain versions."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerhub.operators import history, versions
from ledgerhub.plans import pull_windows
from ledgerhub.plans.run_log import RUN_LOG_DDL
from ledgerhub.scratch import run_folder
from ledgerhub.sinks import tables
from ledgerhub.sources import messages
from ledgerhub.streaming.inbox import inbox_stream
from ledgerhub.streaming.upserts import upsert_stream
from tests.plans_text import exchanges, plan

T0 = datetime(2024, 1, 1)
SNAP = "snapshot_ts TIMESTAMP_NTZ, Entity STRING, no INT, price DOUBLE, note STRING"


def plain_history(rows, extra=()):
    """Versions pull by pull; ``extra`` are (company, time) of pulls without rows."""
    out = []
    for company in {r[1] for r in rows}:
        pulls = sorted({r[0] for r in rows if r[1] == company} | {t for c, t in extra if c == company})
        for no in {r[2] for r in rows if r[1] == company}:
            shown = [{(p, n) for t, e, k, p, n in rows if (t, e, k) == (at, company, no)} for at in pulls]
            for value in set().union(*shown):
                start = None
                for at, now in zip(pulls, shown):
                    if value in now and start is None:
                        start = at
                    if value not in now and start is not None:
                        out.append((company, no, *value, start, at))
                        start = None
                if start is not None:
                    out.append((company, no, *value, start, None))
    return sorted(out, key=repr)


def drawn(seed, days=6):
    rng = random.Random(seed)
    rows = set()
    for d in range(days):
        for company in "AB":
            if company == "B" and d % 2:
                continue
            for no in (1, 2, 3, None):
                if rng.random() < 0.8:
                    rows.add((T0 + timedelta(days=d), company, no, rng.choice([1.0, 1.0, 2.0, None]), rng.choice(["x", "", None]) if d > 3 else "x"))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_versions_of_snapshots(spark, seed):
    rows = drawn(seed)
    extra = [("A", T0 + timedelta(days=9)), ("B", T0 + timedelta(days=3))]
    df = spark.createDataFrame(rows + rows[:5], SNAP)  # a row twice in a pull counts once
    shape = ["Entity", "no", "price", "note", "valid_from", "valid_to"]
    got = history.collapsed(df, ["Entity", "no"])
    assert got.columns == shape
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_history(rows)
    pulls = spark.createDataFrame(extra, "Entity STRING, snapshot_ts TIMESTAMP_NTZ")
    got = history.collapsed(df, ["Entity", "no"], pulls=pulls)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_history(rows, extra)


def test_extending_pull_by_pull_gives_the_same(spark):
    rows = drawn(4)
    df = spark.createDataFrame(rows, SNAP)
    times = sorted({r[0] for r in rows})
    found = history.collapsed(df.where(F.col("snapshot_ts") <= F.lit(times[1])), ["Entity", "no"])
    for at in times[2:]:
        pull = df.where(F.col("snapshot_ts") == F.lit(at)).drop("snapshot_ts")
        found = history.extended(found, pull, F.lit(at).cast("timestamp_ntz"), ["Entity", "no"])
        found = spark.createDataFrame(found.collect(), found.schema)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_history(rows)
    late = T0 + timedelta(days=30)
    complete = spark.createDataFrame([("A",)], "Entity STRING")
    ended = history.extended(found, df.limit(0).drop("snapshot_ts"), F.lit(late).cast("timestamp_ntz"), ["Entity", "no"], complete=complete)
    assert {r["Entity"] for r in ended.where("valid_to is null").collect()} == {"B"}


def test_as_of(spark):
    rows = drawn(5)
    rows = [r for i, r in enumerate(rows) if (r[:3]) not in {x[:3] for x in rows[:i]}]  # one version a key and pull
    found = history.collapsed(spark.createDataFrame(rows, SNAP), ["Entity", "no"])
    asked = [(c, n, T0 + timedelta(hours=h)) for c in "ABC" for n in (1, 3, None, 9) for h in range(-5, 170, 11)]
    asked_df = spark.createDataFrame(asked, "Entity STRING, no INT, at TIMESTAMP_NTZ")
    got = {(r["Entity"], r["no"], r["at"]): (r["price"], r["note"]) for r in history.joined_as_of(asked_df, found, ["Entity", "no"], "at").collect()}
    assert len(got) == len(asked)
    known = plain_history(rows)
    for c, n, at in asked:
        hit = [(p, t) for e, k, p, t, a, b in known if e == c and k == n and n is not None and a <= at and (b is None or at < b)]
        assert got[c, n, at] == (hit[0] if hit else (None, None))
    at = T0 + timedelta(days=2)
    assert history.as_of(found, F.lit(at).cast("timestamp_ntz")).count() == sum(1 for r in known if r[4] <= at and (r[5] is None or at < r[5]))
    with pytest.raises(ValueError, match="Entity must be among"):
        history.collapsed(spark.createDataFrame(rows, SNAP), ["no"])


VERSIONED = "id INT, v INT, t STRING, gone BOOLEAN, Entity STRING"
KEYS = ["id", "Entity"]


def latest(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[3] is not None, bool(r[3]), r[2] is not None, r[2] or "")
    for r in rows:
        key = (r[0], r[4])
        if key not in out or order(r) > order(out[key]):
            out[key] = r
    return sorted(out.values(), key=repr)


def version_rows():
    rng = random.Random(6)
    return [(rng.randint(1, 6), rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), rng.choice([None, False, True]), rng.choice("AB")) for _ in range(60)]


@pytest.mark.parametrize("measured", [False, True])
def test_any_order_of_batches_gives_one_result(spark, measured):
    rows = version_rows()
    parts = [rows[:15], rows[15:40], rows[40:]]
    for order in [(0, 1, 2), (2, 1, 0), (1, 2, 0)]:
        target = spark.createDataFrame([], VERSIONED)
        for i in [*order, order[0]]:
            target = versions.merge_by_version(target, spark.createDataFrame(parts[i], VERSIONED), KEYS, "v", measured)
        assert sorted((tuple(r) for r in target.collect()), key=repr) == latest(rows)
    assert versions.live(target, "gone").count() == sum(1 for r in latest(rows) if not r[3])


def test_a_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(1000).selectExpr("CAST(id AS INT) AS id", "1 AS v", "'a' AS t", "false AS gone", "'A' AS Entity")
    out = versions.merge_by_version(target, target.where("id < 3").withColumn("v", F.lit(2)), KEYS, "v", measured=True)
    assert "FullOuter" not in plan(out)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = versions.merge_by_version(target, target.withColumn("v", F.lit(2)), KEYS, "v")
        assert exchanges(wide) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_files_in_any_order(spark, tmp_path):
    rows = [r for r in version_rows() if r[0] is not None]
    parts = [rows[:15], rows[15:40], rows[40:]]
    schema = spark.createDataFrame([], VERSIONED).schema
    for n, order in enumerate([(0, 1, 2), (2, 0, 1), (1, 2, 0)]):
        landing, checkpoint = f"{tmp_path}/in{n}", f"{tmp_path}/cp{n}"
        name = f"t_{uuid.uuid4().hex}"
        tables.create(spark, name, schema, run_folder(spark, "test"), keys=["id"], buckets=2)
        for i in order:
            spark.createDataFrame(parts[i], VERSIONED).write.mode("append").parquet(landing)
            upsert_stream(spark, landing, schema, name, KEYS, checkpoint, version="v").awaitTermination()
        found = spark.table(name).select("id", "v", "t", "gone", "Entity").collect()
        assert sorted((tuple(r) for r in found), key=repr) == latest(rows)


def test_redelivered_messages(spark, rows, tmp_path):
    """Told by id within a run and after a restart; malformed ones by their text."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    whole = "<m><id>%s</id><t>%s</t></m>"
    runs = [["1", "2", "2"], ["2", "3"], ["1", "4"]]
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for n, ids in enumerate(runs):
        for i, key in enumerate(ids):
            (inbox / f"{n}-{i}.xml").write_text(whole % (key, "same"))
        (inbox / f"{n}-bad.xml").write_text("<m><id>9</id>")
        (inbox / f"{n}-none.xml").write_text("<m><t>no id</t></m>")
        inbox_stream(spark, str(inbox), "id STRING, t STRING", good, bad, str(tmp_path / "cp"), unique=["id"]).awaitTermination()
    assert rows(spark.read.parquet(good), "id", "t") == [("1", "same"), ("2", "same"), ("3", "same"), ("4", "same"), (None, "no id")]
    assert rows(spark.read.parquet(bad), "payload") == [("<m><id>9</id>",)]


def test_windows(spark):
    names = spark.createDataFrame([("A",), ("B",), ("C",)], "name STRING")
    at = lambda d, h=0: datetime(2024, 5, d, h)
    log = spark.createDataFrame([
        ("Success", "x", "job", at(2, 8), at(2, 9), 1, 1, "", "A", ""), ("Error", "x", "job", at(3, 8), at(3, 9), 1, 1, "", "A", ""),
        ("Success", "x", "job", at(6, 8), at(6, 9), 1, 1, "", "A", ""), ("Success", "x", "other", at(4, 8), at(4, 9), 1, 1, "", "A", ""),
        ("Success", "x", "job", at(4, 20), at(4, 21), 1, 1, "", "All", ""), ("Success", "x", "job", None, None, 1, 1, "", "A", ""),
        ("Success", "x", "job", at(4, 8), at(4, 9), 1, 1, "", "Z", ""),
    ], RUN_LOG_DDL)
    since, now = F.lit(at(1)), F.lit(at(7, 12))
    found = pull_windows.pull_windows(log, "job", names, since, now)
    got = sorted((r["Entity"], r["pull_from"], r["pull_to"]) for r in found.collect())
    assert got == [
        ("A", at(2, 8), at(3)), ("A", at(4, 20), at(5)), ("A", at(6, 8), at(7, 12)),
        ("B", at(1), at(3)), ("B", at(4, 20), at(7, 12)), ("C", at(1), at(3)), ("C", at(4, 20), at(7, 12)),
    ]
    changes = [("A", at(2, 7)), ("A", at(2, 8)), ("A", at(3)), ("B", at(2, 23)), ("B", at(4, 21)), ("Z", at(2, 8)), ("A", None)]
    rows = spark.createDataFrame(changes, "Entity STRING, changed TIMESTAMP")
    assert sorted(map(tuple, pull_windows.changed_in(rows, "changed", found).collect())) == [
        ("A", at(2, 8)), ("B", at(2, 23)), ("B", at(4, 21))]
    assert pull_windows.pull_windows(log.limit(0), "job", names, since, now).count() == 3
    assert pull_windows.pull_windows(log, "job", names.limit(0), since, now).count() == 0


XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="m"><xs:complexType><xs:sequence>
<xs:element name="id" type="xs:long"/><xs:element name="t" type="xs:string"/></xs:sequence></xs:complexType></xs:element></xs:schema>"""


def test_xml_files(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(
        "<?xml version='1.0'?><ms>\n<m><id>1</id><t>a &lt; b</t></m><m x='1'>\n<id>2</id><t>two\nlines</t></m>\n<more>x</more>"
        "<m><id>cut<m><id>3</id><t>c</t></m><m><id>x</id><t>d</t></m><m><id>4</id></m></ms>")
    (tmp_path / "in" / "b.xml").write_text("")
    (tmp_path / "in" / "c.xml").write_text("no element")
    schema = spark.createDataFrame([], "id LONG, t STRING").schema
    read = messages.read_xml(spark, str(tmp_path / "in"), "m", schema)
    good, bad = messages.good_and_bad(read)
    assert rows(good) == [(1, "a < b"), (2, "two\nlines"), (3, "c"), (4, None)]
    assert rows(bad) == [("<m><id>cut",), ("<m><id>x</id><t>d</t></m>",)]
    (tmp_path / "m.xsd").write_text(XSD)
    good, bad = messages.good_and_bad(messages.read_xml(spark, str(tmp_path / "in"), "m", schema, str(tmp_path / "m.xsd")))
    assert rows(good) == [(1, "a < b"), (3, "c")]  # 2 has an attribute, 4 lacks a text
    assert len(rows(bad)) == 4
    assert messages.read_xml(spark, str(tmp_path / "in" / "b.xml"), "m", schema).count() == 0
