"""Scores against a plain automaton of dictionaries, sums to one, odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerhub.llm import lm
from ledgerhub.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
START, END = ("start",), ("end",)


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower) + [END]


class Plain:
    """The automaton as dictionaries: arcs and failure arcs of every state, walked word by word."""

    def __init__(self, texts, order, strength):
        self.order, self.m = order, strength
        self.c = Counter()
        for text in texts:
            seq = [START, *tokens(text)]
            for n in range(1, order + 1):
                for i in range(len(seq) - n + 1):
                    self.c[tuple(seq[i:i + n])] += 1
        self.n = sum(v for k, v in self.c.items() if len(k) == 1 and k != (START,))
        self.v = sum(1 for k in self.c if len(k) == 1 and k != (START,))

    def p(self, history, word):
        if not history:
            return (self.c[(word,)] + 1) / (self.n + self.v + 1)
        below = self.p(history[1:], word)
        return (self.c[(*history, word)] + self.m * below) / (self.c[history] + self.m)

    def walk(self, text):
        state, total, base, known = (START,)[:self.order - 1], 0.0, 0.0, 0
        for word in tokens(text):
            total += math.log10(self.p(state, word))
            base += math.log10((self.c[(word,)] + 1) / (self.n + self.v + 1))
            known += self.c[(word,)] > 0
            state = ((*state, word))[-(self.order - 1):] if self.order > 1 else ()
        return total, base, known


TEXTS = [None, "", " \n", "The the THE cat", "the cat sat on the mat\x0bthe\x0ccat", "É é x\x1cy z\x85w", "unseen words here",
         "the cat " * 4000, "the cat sat", "the cat sat"]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_plain_automaton(spark, order):
    rows = [(i, t, i % 3 != 2) for i, t in enumerate(TEXTS)] + [(None, "the mat", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score boolean")
    got = lm.score(df, F.col("score"), order=order, strength=7.0, block_bytes=3000, shard_bytes=2000).collect()
    plain = Plain([t for _, t, train in rows if train], order, 7.0)
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for key, text, _ in rows:
        score, base, known = plain.walk(text)
        r = by_id[key]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens(text)), known, plain.n)
        assert r["score"] == pytest.approx(score, rel=1e-9) and r["base_score"] == pytest.approx(base, rel=1e-9)


@pytest.mark.parametrize("order,lane", [(1, 2), (2, 1), (3, 1), (3, 2), (4, 2), (4, 5)])
def test_lanes_carry_the_state(order, lane):
    """Any cut of long texts into lanes gives the weights of one walk; states and failure arcs are those of the counts."""
    rng = random.Random(order)
    texts = ["".join(rng.choice("ab c ") for _ in range(rng.randint(0, 60))) for _ in range(20)]
    arr = pa.array(texts, pa.string())
    s = lm.sequences(arr)
    levels = lm.keys_by_order(s, order)
    half = np.concatenate([level[s.owner < 10] for level in levels])  # the other texts are not learned from
    learned = lm.counts_in(*np.unique(half[half != 0], return_counts=True))
    distinct, words = np.unique(s.hashes, return_inverse=True)
    automaton, _ = lm.built(levels, distinct, words, learned, 100, 10, 7.0)
    whole = lm.traversed(s, words, automaton, order, lane=10**6)
    assert np.array_equal(whole, lm.traversed(s, words, automaton, order, lane))
    assert (automaton.fails < np.arange(len(automaton.fails)) + (np.arange(len(automaton.fails)) == 0)).all()
    assert len(automaton.fails) == 1 if order == 1 else len(automaton.fails) > 1
    assert len(automaton.arcs) == len(set(automaton.arcs.tolist()))


def test_sums_to_one():
    plain = Plain(["a b a c", "b a"], 3, 7.0)
    words = {k[0] for k in plain.c if len(k) == 1} - {START}
    for history in [(), ("a",), (START,), ("a", "b"), ("never",)]:
        assert sum(plain.p(history, w) for w in words) + plain.p(history, "unknown") == pytest.approx(1)


def test_odd_frames(spark):
    df = spark.createDataFrame([(1, "a b")] * 3, "doc_id long, text string").withColumn("n_known", F.lit("x"))
    got = lm.score(df, F.lit(False)).collect()
    assert len(got) == 3 and {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {(3, 0, 0)}
    assert lm.score(df.limit(0), F.lit(True)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    plain = Plain([t for i, t in docs.items() if not held[i]], lm.ORDER, lm.STRENGTH)
    got = QUERIES["op9_lm"](spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        score, base, known = plain.walk(docs[r["doc_id"]])
        assert r["held_out"] == held[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens(docs[r["doc_id"]])), known, plain.n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    tried = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in tried) > sum(r["base_score"] for r in tried)
