"""Hits against plain search of every window, blocks and passes, removal, odd rows, the query's SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

from check_queries import compare
from ledgerhub.llm import decontaminate
from ledgerhub.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window):
    """Hit places and ids, window by window."""
    own, hit, ids = words(text), set(), set()
    for key, item in items:
        w = words(item)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(own) - size + 1):
                if own[j:j + size] == w[i:i + size]:
                    hit |= set(range(j, j + size))
                    ids.add("" if key is None else str(key))
    return len(own), sorted(hit), sorted(ids)


def places(spans):
    return [i for s in spans for i in range(s["start"], s["end"])]


def check(spark, docs, items, window, **how):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.mark(frame, bench, window=window, **how).collect()
    assert len(got) == len(docs)
    for r in got:
        n, hit, ids = plain(docs[r["doc_id"]], items, window)
        assert (r["n_words"], r["n_hit"], r["hit_items"]) == (n, len(hit), ids)
        assert places(r["hit_spans"]) == hit
        assert all(a["end"] < b["start"] for a, b in zip(r["hit_spans"], r["hit_spans"][1:]))


@pytest.mark.parametrize("seed,block_words,pass_bytes", [(1, 10**6, 10**8), (2, 12, 10**8), (3, 12, 1)])
def test_against_plain_search(spark, seed, block_words, pass_bytes):
    """Few different words, so that windows overlap, repeat, and share suffixes in every way."""
    rng = random.Random(seed)
    draw = lambda n, k: " ".join(rng.choice("abcdef"[:k]) for _ in range(n))
    items = [(i, draw(rng.randint(1, 9), rng.choice([2, 3, 6]))) for i in range(12)]
    items += [(3, draw(5, 3)), (20, items[0][1]), (21, items[5][1]), (None, draw(6, 3))]
    docs = [draw(rng.randint(0, 40), rng.choice([2, 3, 6])) for _ in range(30)]
    check(spark, docs, items, 4, block_words=block_words, pass_bytes=pass_bytes)


def test_odd_texts(spark):
    items = [(1, "The quick-brown É fox"), (2, None), (3, ""), (4, " -- "), (5, "x9"), (6, "fox x9 the")]
    docs = [None, "", "  ", "THE QUICK brown é fox", "the quick brown É fox", "x9", "X9!fox,x9\x7fTHE\x00quick", "x\u00859",
            "fox x9 " * 5000 + "the quick brown É fox"]
    check(spark, docs, items, 3)


def test_no_items_no_docs(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string").withColumn("n_hit", F.lit("x"))
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    row = decontaminate.mark(docs, items.limit(0)).first()
    assert (row["n_words"], row["n_hit"], row["hit_items"], row["hit_spans"]) == (3, 0, [], [])
    assert decontaminate.mark(docs.limit(0), items).count() == 0
    assert decontaminate.mark(docs, items).first()["n_hit"] == 2


def test_repeated_rows_stay(spark):
    docs = spark.createDataFrame([(1, "q a b q")] * 5, "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b")] * 300, "item_id long, text string")
    got = decontaminate.mark(docs, items).collect()
    assert len(got) == 5 and all(r["hit_items"] == ["7"] and r["n_hit"] == 2 for r in got)


def test_removal(spark):
    items = spark.createDataFrame([(1, "one two three four"), (2, "so long")], "item_id long, text string")
    texts = ["É start: One, two;three FOUR! end", "so long", "and so long it goes on and on", "one two three four five", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.decontaminated(docs, items, window=4, max_span=3, max_coverage=0.7).collect()}
    assert [got[i]["clean_text"] for i in range(6)] == ["É start: ! end", None, texts[2], None, None, ""]
    assert [got[i]["dropped"] for i in range(6)] == [False, True, False, True, False, False]


def test_passes():
    assert decontaminate.passes([], 10) == []
    assert decontaminate.passes([(0, 4), (1, 6), (2, 1), (3, 99), (4, 2)], 10) == [[0, 1], [2], [3], [4]]


def test_query(spark, con, small):
    good, note = compare(QUERIES["op11_decontaminate"](spark, small), con, ORACLES["op11_decontaminate"])
    assert good, note
