"""Differences against plain sums over all words, any block sizes, flushes, odd rows, the query's SQL."""

import re
from collections import Counter

import pyarrow as pa
import pytest

from check_queries import compare
from ledgerhub.llm import divergence
from ledgerhub.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == lang]
        docs = Counter(t for r in own for t in set(terms(r[0])))
        kept = sorted(t for t, n in docs.items() if n >= least)
        v = len(kept)

        def shares(texts):
            n = Counter(t for x in texts for t in terms(x) if docs[t] >= least)
            total = sum(n.values())
            return n, {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * v) for t in kept}

        _, q = shares([r[0] for r in own])
        found = {s: shares([r[0] for r in own if r[2] == s]) for s in {r[2] for r in own}}
        for s, (n, p) in found.items():
            pairs = [(-sum(abs(p[t] - found[o][1][t]) for t in kept), o) for o in found if o != s]
            words = [(q[t] - p[t], t) for t in kept if n[t] > 0 and p[t] > q[t]]
            for part, listed in (("pair", pairs), ("term", words)):
                ranked = sorted(listed, key=lambda x: (x[0], x[1].encode()))[:top if part == "term" else None]
                out |= {(lang, s, part, o, -value, i + 1) for i, (value, o) in enumerate(ranked)}
    return out


def rows():
    base = ["The cat AND the dog, and_the Éé ñandú", "cat cat cat dog", "the-the the 123 cat", "ñandú ñandú the", "dog", "日本 the 日本", "ÉÉ x"]
    out = [(base[(i * i + j) % 7], lang, f"s{(i * j + i) % 9}") for i in range(20) for j, lang in enumerate(["a", "b"])]
    return out + [(None, "a", "empty"), ("...", "a", "marks"), ("the cat", None, None), ("the cat", "", ""), ("alone", "z", "s1"),
                  ("alone", "z", "s2"), (None, None, "s"), ("the " * 3000, "a", "s1"), ("dog ties", "a", "S1")]


def got(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("groups,words", [(32, 4096), (1, 1), (2, 3)])
def test_against_plain_sums(spark, groups, words):
    df = spark.createDataFrame(rows(), "text string, lang string, source string").repartition(5)
    result = divergence.audit(df, least_documents=3, top_terms=4, groups_in_block=groups, terms_in_block=words)
    assert result.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = result.collect()
    assert len(found) == len(got(result)) and {tuple(r) for r in found} == plain(rows(), 3, 4)


def test_flushes(monkeypatch):
    """Words sent on in many small parts add up to the same counts."""
    batch = pa.RecordBatch.from_pydict({"text": [r[0] or "" for r in rows()], "lang": [r[1] or "" for r in rows()],
                                        "source": [r[2] or "" for r in rows()]})
    def total():
        n = Counter()
        for part in divergence.count_terms(iter([batch, batch])):
            for r in part.to_pylist():
                n[r["lang"], r["source"], r["term"], "n"] += r["n"]
                n[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return n
    whole = total()
    monkeypatch.setattr(divergence, "MOST_COUNTED", 1)
    monkeypatch.setattr(divergence, "ROWS_OUT", 2)
    assert total() == whole


def test_empty_and_large_numbers(spark):
    df = spark.createDataFrame([], "text string, lang string, source string, n long, term string")
    assert divergence.audit(df).count() == 0
    big = spark.createDataFrame([(10**13, 3 * 10**13, 1000)], "n long, total long, v long")
    share = big.select(divergence.share(big["n"], big["total"], big["v"]).alias("p")).first()["p"]
    assert share == 1 + 10**9 * (10**13 + 5) // (3 * 10**13 + 5000)


def test_query(spark, con, small):
    good, note = compare(QUERIES["op12_divergence"](spark, small), con, ORACLES["op12_divergence"])
    assert good, note
