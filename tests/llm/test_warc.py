"""Archives: format, exact round trip, damaged input and the query against SQL."""

import gzip
import hashlib
import io

import pytest

from check_queries import compare
from ledgerhub.llm import warc
from ledgerhub.llm.common import run_folder
from ledgerhub.llm.queries import ORACLES, QUERIES

LONG = "<p>ä</p>" * 200


def test_one_member_per_record():
    data = b"".join(warc.record(i, f"http://x/{i}", b"abc" * i, None, "2024-01-01T00:00:00Z") for i in range(3))
    text = gzip.decompress(data)
    assert text.count(b"WARC/1.1\r\n") == 3 and data.count(b"\x1f\x8b\x08") == 3
    got = list(warc.records(io.BytesIO(data)))
    assert [(r["page_id"], r["payload"], r["problem"]) for r in got] == [
        (0, b"", None), (1, b"abc", None), (2, b"abcabc", None)
    ]


@pytest.mark.parametrize("cut", [1, 5, 40, 200])
def test_truncated_archive(cut):
    one = warc.record(1, "u", b"x" * 5000, None, "d")
    got = list(warc.records(io.BytesIO(one + one[:-cut] if cut < len(one) else one)))
    assert got[0]["problem"] is None and got[1]["problem"].startswith("unreadable")


def test_wrong_digests_and_lengths():
    raw = gzip.decompress(warc.record(1, "u", b"payload", None, "d"))
    changed = gzip.compress(raw.replace(b"\r\npayload", b"\r\nPayload"))
    assert next(warc.records(io.BytesIO(changed)))["problem"] == "block digest differs"
    longer = gzip.compress(raw.replace(b"\r\n\r\nHTTP", b"\r\n\r\nxHTTP"))
    assert next(warc.records(io.BytesIO(longer)))["problem"] is not None
    assert next(warc.records(io.BytesIO(gzip.compress(b"hello\r\n\r\n"))))["problem"].startswith("unreadable")


def test_round_trip(spark):
    rows = [
        (1, "http://a/\r\nx", LONG, 1), (2, None, LONG, 1), (3, "u", LONG, 1), (3, "u", LONG, 1),
        (4, "u", "short", 1), (5, "u", "short", 1), (6, "u", None, 1), (7, "u", "", 1),
        (None, "u", LONG, 1), (None, "u", "n" * 2000, 1), (8, "v", "b" * 3_000_000, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to int")
    manifest = warc.write_archives(pages, run_folder(spark, "t"), archive_bytes=2000)
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(rows) and all(r["problem"] is None for r in got)
    by_key = {}
    for r in got:
        by_key.setdefault((r["page_id"], r["payload_bytes"]), []).append(r)
    size = len(LONG.encode())
    for page_id in (1, 2, None):
        (r,) = by_key[page_id, size]
        assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", 3, None)
        assert r["payload_digest"] == hashlib.sha1(LONG.encode()).hexdigest()
    assert [r["record_type"] for r in by_key[3, size]] == ["response"] * 2
    assert {bytes(r["payload"]) for r in by_key[3, size]} == {LONG.encode()}
    assert by_key[1, size][0]["url"] == "http://a/%0D%0Ax" and by_key[2, size][0]["url"] is None
    assert [by_key[i, 5][0]["record_type"] for i in (4, 5)] == ["response"] * 2
    assert bytes(by_key[6, 0][0]["payload"]) == b"" and by_key[None, 2000][0]["record_type"] == "response"
    assert bytes(by_key[8, 3_000_000][0]["payload"]) == b"b" * 3_000_000


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, run_folder(spark, "t"))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def test_query(spark, con, small):
    good, note = compare(QUERIES["op10_warc"](spark, small), con, ORACLES["op10_warc"])
    assert good, note
