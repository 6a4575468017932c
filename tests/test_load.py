"""Load patterns: hand-made cases and properties."""

import random

import pytest
from pyspark.errors import PySparkException

from ledgerhub.operators import load
from ledgerhub.operators.latest import first_per_key, last_per_key
from ledgerhub.operators.presence import absent, present
from ledgerhub.operators.watermark import above_watermark, high_watermarks

KEYS = ["no", "Entity"]
DDL = "no INT, v STRING, Entity STRING"
LANDED = DDL + ", pos INT"


@pytest.fixture
def frame(spark):
    return lambda data, ddl=DDL: spark.createDataFrame(data, ddl)


def test_replace_all_keeps_repeats(frame, rows):
    out = load.replace_all(frame([(1, "a", "A")]), frame([(1, "b", "A"), (1, "c", "A")]), KEYS)
    assert rows(out) == [(1, "b", "A"), (1, "c", "A")]


def test_replace_last_keeps_last_arrival(frame, rows):
    batch = frame([(1, "z", "A", 1), (1, "c", "A", 2)], LANDED)
    assert rows(load.replace_last(frame([(1, "a", "A")]), batch, KEYS, ["pos"])) == [(1, "c", "A")]


def test_insert_absent_keeps_first_and_never_updates(frame, rows):
    batch = frame([(1, "b", "A", 1), (2, "x", "A", 2), (2, "a", "A", 3), (None, "n", "A", 4)], LANDED)
    out = load.insert_absent(frame([(1, "a", "A")]), batch, KEYS, ["pos"], required="no")
    assert rows(out) == [(1, "a", "A"), (2, "x", "A")]


def test_upsert_updates_inserts_and_keeps(frame, rows):
    target = frame([(1, "a", "A"), (3, "z", "A")])
    out = load.upsert(target, frame([(1, "b", "A"), (2, "x", "A")]), KEYS)
    assert rows(out) == [(1, "b", "A"), (2, "x", "A"), (3, "z", "A")]


@pytest.mark.parametrize("measured", [False, True])
def test_upsert_is_a_merge(frame, rows, measured):
    """Every matching target row is updated, repeated ones too; NULL keys match nothing."""
    random.seed(21)
    target = [(random.randint(0, 40), f"old{i}", random.choice("AB")) for i in range(200)]
    target += [(None, "null", "A")]
    keys = random.sample([(n, e) for n in range(60) for e in "AB"], 50)
    batch = [(n, f"new{n}", e) for n, e in keys]
    fresh = {(n, e): v for n, v, e in batch}
    known = {(n, e) for n, _, e in target}
    expected = [(n, fresh.get((n, e), v), e) for n, v, e in target]
    expected += [(n, v, e) for n, v, e in batch if (n, e) not in known]
    out = load.upsert(frame(target), frame(batch), KEYS, measured)
    assert rows(out) == sorted(expected, key=repr)


def test_upsert_refuses_repeated_keys(frame):
    batch = frame([(1, "b", "A"), (1, "c", "A")])
    with pytest.raises(PySparkException, match="repeats key"):
        load.upsert(frame([(1, "a", "A")]), batch, KEYS).collect()


def test_upsert_keeps_columns_the_batch_lacks(spark, rows):
    target = spark.createDataFrame([(1, "a", "keep", "A")], "no INT, v STRING, extra STRING, Entity STRING")
    batch = spark.createDataFrame([(1, "b", "A"), (2, "x", "A")], DDL)
    out = load.upsert(target, batch, KEYS)
    assert rows(out) == [(1, "b", "keep", "A"), (2, "x", None, "A")]


@pytest.mark.parametrize("pattern", [load.upsert, load.replace_all])
def test_other_company_is_untouched(frame, rows, pattern):
    target = frame([(1, "a", "A"), (1, "a", "B")])
    out = pattern(target, frame([(1, "new", "A")]), KEYS)
    assert rows(out) == [(1, "a", "B"), (1, "new", "A")]


def test_null_keys_match_nothing(frame, rows):
    target = frame([(None, "old", "A"), (1, "a", "A")])
    out = load.replace_all(target, frame([(None, "new", "A")]), KEYS)
    assert rows(out) == [(1, "a", "A"), (None, "new", "A"), (None, "old", "A")]


@pytest.mark.parametrize("measured", [False, True])
def test_probes_split_the_input(frame, rows, measured):
    left, right = frame([(i, "v", "A") for i in range(9)]), frame([(i, "w", "A") for i in (2, 4, 4)])
    parts = absent(left, right, KEYS, measured).unionByName(present(left, right, KEYS, measured))
    assert rows(parts) == rows(left)
    assert rows(present(left, right, KEYS, measured), "no") == [(2,), (4,)]


def test_append_above_watermark(spark, rows):
    ddl = "entryNo BIGINT, Entity STRING"
    target = spark.createDataFrame([(10, "A"), (3, "A")], ddl)
    batch = spark.createDataFrame([(10, "A"), (11, "A"), (0, "B"), (1, "B"), (5, None)], ddl)
    assert rows(above_watermark(batch, target, "entryNo")) == [(1, "B"), (11, "A"), (5, None)]
    assert rows(load.append_above(target, batch, "entryNo")) == [
        (1, "B"), (10, "A"), (11, "A"), (3, "A"), (5, None),
    ]


@pytest.mark.parametrize("companies", [3, 80])
def test_watermark_as_filter_and_as_join_agree(spark, rows, companies):
    random.seed(companies)
    made = [(random.randint(0, 500), f"C'{i % companies}") for i in range(2000)]
    ddl = "entryNo INT, Entity STRING"
    target, batch = spark.createDataFrame(made[:700], ddl), spark.createDataFrame(made, ddl)
    top = {}
    for number, company in made[:700]:
        top[company] = max(top.get(company, 0), number)
    expected = sorted(((n, c) for n, c in made if n > top.get(c, 0)), key=repr)
    assert rows(above_watermark(batch, target, "entryNo")) == expected


def test_append_in_two_steps_is_append_at_once(spark, rows):
    ddl = "entryNo INT, Entity STRING"
    empty = spark.createDataFrame([], ddl)
    early = spark.createDataFrame([(i, c) for i in range(1, 6) for c in "AB"], ddl)
    full = spark.createDataFrame([(i, c) for i in range(1, 12) for c in "AB"], ddl)
    stepwise = load.append_above(load.append_above(empty, early, "entryNo"), full, "entryNo")
    assert rows(stepwise) == rows(load.append_above(empty, full, "entryNo"))


def test_watermarks(spark, rows):
    target = spark.createDataFrame([(10, "A"), (3, "A"), (7, "B")], "entryNo INT, Entity STRING")
    assert rows(high_watermarks(target, "entryNo")) == [("A", 10), ("B", 7)]


def test_applying_a_batch_twice_changes_nothing(frame, rows):
    random.seed(5)
    target = frame([(i, "old", "AB"[i % 2]) for i in range(50)])
    unique = frame([(i, "new", "AB"[i % 2]) for i in random.sample(range(80), 30)])
    landed = frame([(random.randint(0, 80), f"v{i}", "A", i) for i in range(60)], LANDED)
    once = load.upsert(target, unique, KEYS)
    assert rows(load.upsert(once, unique, KEYS)) == rows(once)
    once = load.replace_last(target, landed, KEYS, ["pos"])
    assert rows(load.replace_last(once, landed, KEYS, ["pos"])) == rows(once)
    once = load.insert_absent(target, landed, KEYS, ["pos"])
    assert rows(load.insert_absent(once, landed, KEYS, ["pos"])) == rows(once)


def test_one_per_key_with_a_hot_key(frame, rows):
    """One key holds most rows; the result is that of a plain dictionary."""
    random.seed(9)
    data = [(0 if random.random() < 0.6 else random.randint(1, 40), f"v{i}", "A", i) for i in range(4000)]
    random.shuffle(data)
    batch = frame(data, LANDED).repartition(16)
    last, first = {}, {}
    for no, v, entity, pos in sorted(data, key=lambda r: r[3]):
        last[no] = (no, v, entity, pos)
        first.setdefault(no, (no, v, entity, pos))
    assert rows(last_per_key(batch, KEYS, ["pos"]), *batch.columns) == sorted(last.values(), key=repr)
    assert rows(first_per_key(batch, KEYS, ["pos"]), *batch.columns) == sorted(first.values(), key=repr)


def test_fan_out_does_not_depend_on_order(frame, rows):
    a, b = frame([(1, "a", "A")]), frame([(2, "B")], "no INT, Entity STRING")
    forward = load.fan_out([a, b]).select("no", "v", "Entity")
    backward = load.fan_out([b, a]).select("no", "v", "Entity")
    assert rows(forward) == rows(backward) == [(1, "a", "A"), (2, None, "B")]
