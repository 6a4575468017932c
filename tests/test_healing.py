"""Interval sets and digest levels against plain sets, whatever the widths; plans."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerhub.operators import digests, intervals
from ledgerhub.plans import count_check, digest_check
from ledgerhub.warehouse_queries.healing import faulty_copy
from tests.plans_text import exchanges, plan

IV = "Entity STRING, lo BIGINT, hi BIGINT"


def numbers(rows):
    out = {}
    for entity, lo, hi in rows:
        out.setdefault(entity, set()).update(range(lo, hi))
    return {e: n for e, n in out.items() if n}


def maximal(rows):
    """Disjoint intervals that don't touch."""
    by = {}
    for e, lo, hi in rows:
        by.setdefault(e, []).append((lo, hi))
    return all(lo < hi for own in by.values() for lo, hi in own) and all(
        a[1] < b[0] for own in by.values() for a, b in zip(sorted(own), sorted(own)[1:]))


def collected(df):
    return [(r["Entity"], r["lo"], r["hi"]) for r in df.collect()]


@pytest.mark.parametrize("width,seed", [(4, 1), (7, 2), (intervals.WIDTH, 1)])
def test_sets_against_plain_ones(spark, width, seed):
    rng = random.Random(seed)
    draw = lambda: [(rng.choice(["A", "B", None]), lo, lo + rng.randint(-1, 9)) for lo in (rng.randint(-30, 40) for _ in range(25))]
    a, b = draw(), draw()
    left, right = spark.createDataFrame(a, IV), spark.createDataFrame(b, IV)
    na, nb = numbers(a), numbers(b)
    for found, expected in (
        (intervals.united(left, width=width), na),
        (intervals.without(left, right, width=width), {e: n - nb.get(e, set()) for e, n in na.items()}),
        (intervals.common(left, right, width=width), {e: n & nb.get(e, set()) for e, n in na.items()}),
        (intervals.gaps(left, width=width), {e: set(range(min(n), max(n))) - n for e, n in na.items()}),
        (intervals.gaps(left, width=width, start=-50), {e: set(range(-50, max(n))) - n for e, n in na.items()}),
    ):
        rows = collected(found)
        assert numbers(rows) == {e: n for e, n in expected.items() if n} and maximal(rows)
    sizes = {r["Entity"]: r["numbers"] for r in intervals.size(intervals.united(left, width=width)).collect()}
    assert sizes == {e: len(n) for e, n in na.items()}


@pytest.mark.parametrize("width", [5, intervals.WIDTH])
def test_numbers_and_covered_rows(spark, width):
    rng = random.Random(3)
    rows = [(rng.choice("AB"), rng.choice([None, rng.randint(-20, 60)]), i) for i in range(120)] + [("A", 7, -i) for i in range(200)]
    df = spark.createDataFrame(rows, "Entity STRING, n INT, i INT")
    found = collected(intervals.of_numbers(df, "n", width=width))
    assert numbers(found) == {e: {n for x, n, _ in rows if x == e and n is not None} for e in "AB"} and maximal(found)
    wanted = [("A", -5, 8), ("A", 30, 31), ("B", 10, 40), ("C", 0, 9)]
    inside = intervals.covered(df, "n", spark.createDataFrame(wanted, IV), width=width)
    assert inside.columns == df.columns
    expected = [r for r in rows if r[1] is not None and any(e == r[0] and lo <= r[1] < hi for e, lo, hi in wanted)]
    assert sorted(map(tuple, inside.collect())) == sorted(expected)


def test_large_numbers(spark):
    big = 9_007_199_254_740_993
    df = spark.createDataFrame([("A", big), ("A", big + 1), ("A", big + 3)], "Entity STRING, n BIGINT")
    assert sorted(collected(intervals.of_numbers(df, "n"))) == [("A", big, big + 2), ("A", big + 3, big + 4)]
    gap = count_check.entry_gaps(df, "n").collect()
    assert [tuple(r) for r in gap] == [("A", big + 2, big + 2, 1)]


def test_empty_and_whole(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2)], "Entity STRING, n BIGINT")
    none = df.limit(0)
    assert count_check.entry_gaps(df, "n").count() == 0 and count_check.entry_gaps(none, "n").count() == 0
    assert count_check.hole_rows(df, df, "n").count() == 0 and count_check.hole_rows(none, df, "n").count() == 0
    assert count_check.hole_rows(df, none, "n").count() == 2


def test_a_number_that_most_rows_have_is_dropped_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("concat('c', id % 3) AS Entity", "id % 7 AS n")
    text = plan(intervals.of_numbers(df, "n"))
    lowest = text[text.rindex("Exchange"):]  # what lies below the first exchange
    assert "HashAggregate" in lowest


SOURCE = "k BIGINT, t STRING, v DOUBLE, Entity STRING"


def plain_compare(a, b):
    out = {}
    for e, k in {(r[3], r[0]) for r in a + b}:
        x, y = (sorted([r for r in rows if (r[3], r[0]) == (e, k)], key=repr) for rows in (a, b))
        if x != y:
            out[e, k] = (len(x), len(y), "missing" if not y else "extra" if not x else "changed" if len(x) == len(y) else "repeated")
    return out


@pytest.mark.parametrize("number,widths", [("k", (64, 8)), ("k", digests.WIDTHS), (None, (5,)), (None, digests.WIDTHS)])
def test_compare_against_plain_rows(spark, number, widths):
    rng = random.Random(5)
    a = [(k, rng.choice(["x", "", None]), rng.choice([1.5, None]), rng.choice(["A", "B"])) for k in range(-50, 150)] + [(None, "n", 1.0, "A")]
    b = [r for r in a if r[0] is None or r[0] % 17 != 3]
    b = [(k, None if t == "" and k % 5 == 0 else t, v, e) if k is not None else (k, t, 2.0, e) for k, t, v, e in b]
    b += [r for r in b if r[0] in (7, 8)] * 2 + [(900, "s", 1.0, "B"), (5, "other company", 1.0, "C")]
    left, right = spark.createDataFrame(a, SOURCE), spark.createDataFrame(b, SOURCE).repartition(3)
    found = digest_check.digest_check(left, right, ["k"], number=number, widths=widths).collect()
    assert {(r["Entity"], r["k"]): (r["left_rows"], r["right_rows"], r["status"]) for r in found} == plain_compare(a, b)
    assert len(found) == len(plain_compare(a, b)) > 10


def test_equal_tables_and_empty_ones(spark):
    df = spark.range(500).selectExpr("id AS k", "cast(id as string) AS t", "id * 0.5 AS v", "concat('c', id % 3) AS Entity")
    assert digest_check.digest_check(df, df.orderBy(F.desc("k")), ["k"], number="k").count() == 0
    assert digest_check.digest_check(df.limit(0), df.limit(0), ["k"]).count() == 0
    assert digest_check.digest_check(df, df.limit(0), ["k"], number="k").count() == 500


def test_level_two_reads_little(spark, tmp_path):
    """A million rows with a few faults close together and far apart: what is left to read of each table."""
    df = spark.range(0, 1_000_000, 1, 8).selectExpr("id AS entryNo", "concat('c', id % 4) AS Entity", "id * 0.25D AS total", "'O' AS status", "'p' AS priority")
    df.repartitionByRange(16, "entryNo").sortWithinPartitions("entryNo").write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    bad = F.col("entryNo").isin(5, 17, 400_000, 999_999)
    table = source.withColumn("total", F.when(bad, F.lit(0.125)).otherwise(F.col("total")))
    c = digest_check.compared(source, table, ["entryNo"], number="entryNo")
    ranges = digests.differing_ranges(source, table, c, 1 << 14)
    level = digests.rows_within(source, ranges, c, 1 << 14)
    assert level.count() < 0.02 * 1_000_000
    assert "PushedFilters: [Or(" in plan(level)
    left, _ = digests.narrowed(source, table, c, (1 << 14, 1 << 8))
    assert left.count() <= 4 * 64
    found = digests.compare(source, table, c, (1 << 14, 1 << 8))
    assert sorted(r["entryNo"] for r in found.collect()) == [5, 17, 400_000, 999_999]


def test_both_sides_of_the_filter_bound(spark, monkeypatch):
    source = spark.range(3000).selectExpr("id AS entryNo", "'A' AS Entity", "cast(id as double) AS total", "'O' AS status", "'p' AS priority")
    table = faulty_copy(source)
    expected = None
    for bound in (0, 1, digests.MAX_FILTER_RANGES):
        monkeypatch.setattr(digests, "MAX_FILTER_RANGES", bound)
        found = sorted(tuple(r) for r in digest_check.digest_check(source, table, ["entryNo"], number="entryNo", widths=(64, 4)).collect())
        expected = expected or found
        assert found == expected and len(found) > 10


def test_columns_of_two_types_are_refused(spark):
    df = spark.range(3).selectExpr("id AS k", "'A' AS Entity", "1 AS v")
    with pytest.raises(ValueError, match="v: int and double"):
        digest_check.digest_check(df, df.withColumn("v", F.col("v").cast("double")), ["k"])


def test_one_exchange_a_level(spark):
    df = spark.range(100).selectExpr("id AS k", "'A' AS Entity", "1 AS v")
    c = digest_check.compared(df, df, ["k"], number="k")
    out = digests.differing_ranges(df, df, c, 16)
    assert exchanges(out) == 1 and "Join" not in plan(out)
