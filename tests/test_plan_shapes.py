"""Physical plans: what must hold for large tables."""

import re

from pyspark.sql import functions as F

from ledgerhub.operators.alignment import aligned_amounts
from ledgerhub.operators.latest import last_per_key
from ledgerhub.operators.load import upsert
from ledgerhub.operators.presence import flagged
from ledgerhub.operators.watermark import above_watermark
from ledgerhub.sizing import broadcast_within, local_copy, measured_size
from ledgerhub.warehouse_queries import QUERIES
from tests.plans_text import exchanges, plan

FOLDER = "/root/testdata/sf0.001"


def test_one_exchange_for_all_sums(spark):
    part = lambda: spark.range(10).selectExpr("id AS account", "'A' AS Entity", "1.5bd AS amount")
    out = aligned_amounts(part(), {"a": part(), "b": part(), "c": part()})
    assert exchanges(out) == 1
    assert "Join" not in plan(out)


def test_upsert_shuffles_each_side_once_and_sorts_no_whole_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
        out = upsert(orders, orders.where("o_orderkey % 3 = 0"), ["o_orderkey"])
        assert exchanges(out) == 2 and plan(out).count("FullOuter") >= 1
        assert "SortAggregate" not in plan(out)
        assert exchanges(flagged(orders, orders, ["o_orderkey"], "known")) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_headers_carry_no_whole_header_to_the_shuffle(spark):
    text = plan(QUERIES["payment_match"](spark, FOLDER))
    assert "SortAggregate" not in text


def test_candidates_are_cut_before_their_one_exchange(spark):
    """Pieces of descriptions come from three generators and are cut down to wanted numbers, and one each, before the shuffle."""
    from ledgerhub.plans import payments
    from ledgerhub.warehouse_queries import matching

    invoices = matching._open_invoices(spark, FOLDER).where("company is not null")
    headers = matching._headers(spark, FOLDER).select("company", "kind", "no", "id", "postingDescription")
    pieces = payments._candidates(headers, ["company", "kind", "no", "id"], invoices)
    assert exchanges(pieces) == exchanges(headers) * 2  # digits-only and other numbers; none of their own
    assert plan(pieces).split("\n\n")[0].count("Generate") == 6


def test_wanted_numbers_too_many_to_broadcast_cut_pieces_before_the_shuffle(spark, monkeypatch):
    """Beyond MAX_WANTED, pieces meet the sieve's broadcast bits and are cut to one a number before they are shuffled."""
    from ledgerhub.plans import payments

    found = []
    monkeypatch.setattr(payments, "MAX_WANTED", 0)
    monkeypatch.setattr(payments, "written_once", lambda df, purpose: found.append(plan(df)) or df)
    headers = spark.range(100).selectExpr(
        "'X' AS company", "'s' AS kind", "concat('n', id) AS no", "concat('i', id) AS id", "concat('No ', id, ' and A-', id) AS postingDescription")
    invoices = headers.selectExpr("if(no < 'n5', substr(no, 2), concat('A-', substr(no, 2))) AS invoice_no", "company", "kind")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        payments._first_places(headers, invoices, ["no", "id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [(re.search(r"[A-Z]", line).start(), line) for line in found[0].split("\n\n")[0].splitlines()[1:]]
    at = max(i for i, (_, line) in enumerate(lines) if "Generate" in line)
    above, depth = [], lines[at][0]  # what the pieces pass on their way up
    for column, line in reversed(lines[:at]):
        if column < depth:
            above.append(line[column:])
            depth = column
    shuffled = next(i for i, line in enumerate(above) if line.startswith("Exchange"))
    assert any(line.startswith("BroadcastHashJoin LeftSemi") for line in above[:shuffled])
    assert any(line.startswith("WindowGroupLimit") for line in above[:shuffled])


def test_a_sieve_keeps_every_key_that_occurs(spark):
    from ledgerhub.operators.presence import sieved

    rows = spark.range(20000).selectExpr("if(id % 100 = 99, NULL, id) AS a", "concat('k', id % 3) AS b")
    wanted = rows.where("a % 10 = 0 OR a IS NULL").union(rows.where("a = 10"))
    kept = sieved(rows, wanted, ["a", "b"])
    assert kept.columns == ["a", "b"]
    assert kept.where("a % 10 = 0 OR a IS NULL").count() == 2000 + 200
    assert kept.count() < 2200 + 17800 * 0.05
    assert sieved(rows, wanted.limit(0), ["a", "b"]).count() == 0


def test_company_sides_at_both_sides_of_their_bound(spark):
    from ledgerhub.sizing import company_side

    frame = spark.createDataFrame([(f"c{i}", i) for i in range(6)], "Entity STRING, n INT")
    rows = spark.range(30).selectExpr("concat('c', id % 9) AS Entity", "id")
    found = [sorted(map(tuple, rows.join(company_side(frame, most), "Entity").collect())) for most in (5, 6, 7)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 21


def test_last_per_key_cuts_rows_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(last_per_key(lines, ["l_orderkey"], ["l_shipdate"]))
    assert "Partial" in text and "WindowGroupLimit" in text


def test_watermarks_reach_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    old = orders.where("o_orderkey < 900")
    text = plan(above_watermark(orders, old, "o_orderkey", "o_orderstatus"))
    assert "PushedFilters: [Or(" in text and "GreaterThan(o_orderkey" in text
    assert "Exchange" not in text


def test_measured_sides(spark):
    small = spark.createDataFrame([("ab",), (None,)], "k STRING")
    assert measured_size(small) == (2, 34)
    assert "ResolvedHint" in broadcast_within(small)._jdf.queryExecution().analyzed().toString()
    for bounds in ({"max_rows": 1}, {"max_bytes": 10}):
        kept = broadcast_within(small, **bounds)
        assert "ResolvedHint" not in kept._jdf.queryExecution().analyzed().toString()
    assert local_copy(small, 1) is None
    assert sorted(map(str, local_copy(small, 2).collect())) == ["Row(k='ab')", "Row(k=None)"]
    assert measured_size(small.select(F.array("k").alias("a")))[1] > 32


def test_far_too_many_distinct_keys_are_not_shuffled_to_count_them(spark, monkeypatch):
    from ledgerhub import sizing

    measured = []
    size = sizing.fits_broadcast
    monkeypatch.setattr(sizing, "fits_broadcast", lambda df, *bounds: measured.append(df) or size(df, *bounds))
    many, few = spark.range(5000), spark.range(5000).selectExpr("id % 7 AS id")
    assert sizing.distinct_within(many, max_rows=100).count() == 5000 and len(measured) == 1
    assert "BroadcastHashJoin" in plan(many.join(sizing.distinct_within(few, max_rows=100), "id", "left_semi"))


def test_only_keys_with_equal_hashes_are_sieved(spark):
    from ledgerhub.operators import presence

    df, other = spark.range(3).selectExpr("id", "0.0D AS x"), spark.range(3).selectExpr("CAST(id AS INT) AS id", "-0.0D AS x")
    assert presence.sievable(df, df, ["id"])
    assert not presence.sievable(df, other, ["id"]) and not presence.sievable(df, other, ["x"])
