"""Cuts against tokens from a pattern, chunks that follow their content, odd rows, the query's SQL."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from check_queries import compare
from ledgerhub.llm import fim
from ledgerhub.llm.queries import ORACLES, QUERIES

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
P, S, M = "<P>", "<S>", "<M>"


def plain(key, text, seed=42, rate=50, suffix_first=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in (P, S, M)) or h3 % 100 >= rate:
        return len(tokens), "plain", None, None, text
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    pre, mid, suf = ("".join(tokens[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    form = "spm" if h4 % 100 < suffix_first else "psm"
    out = P + pre + S + suf + M + mid if form == "psm" else S + suf + P + pre + M + mid
    return len(tokens), form, len(pre), len(mid), out


def texts():
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdé ñ\n\t日本") for _ in range(9000))
    out = [None, "", " ", "\n\n ", "one", " one", "one ", "x<P>y", "a <S> b", "<M>", "<", "a<", "<S", "\x1c \x85 \xa0 x\x0by"]
    out += [passage, passage[17:], "z" * 20000, " " * 20000, "é" * 9001 + " " + "日" * 5000, " word" * 6000]
    out += ["".join(rng.choice("ab <>PSM\n é") for _ in range(rng.randint(0, 300))) for _ in range(150)]
    return out


def test_against_pattern(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no key at all"), (5, "key five again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit(1)).repartition(3)
    made = fim.transform(df, rate=90, suffix_first=50)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        made_of = tuple(r[c] for c in ("n", "form", "prefix_chars", "middle_chars", "output"))
        assert made_of == plain(r["doc_id"], r["text"], rate=90, suffix_first=50)
        assert r["back"] == (r["text"] or "")


def test_every_cut_of_a_text():
    rng = random.Random(9)
    for size in (0, 1, 5, 700, 3000):
        text = "".join(rng.choice(["a", "é", "日", " ", " ", "\n", "word"]) for _ in range(size))
        tokens = TOKEN.findall(text)
        (doc,) = fim.documents([text.encode()], fim.Chunks())
        assert doc.tokens == len(tokens)
        assert [doc.chars_before(k) for k in range(len(tokens) + 1)] == [
            len("".join(tokens[:k])) for k in range(len(tokens) + 1)]


def test_rolling_hash():
    data = np.random.default_rng(1).integers(0, 256, 500).astype(np.uint8)
    h = fim.rolling(data)
    for i in (0, 1, 31, 32, 333, 499):
        assert h[i] == sum(int(fim.GEAR[data[i - j]]) << j for j in range(min(32, i + 1))) % 2**32
    assert len(set(fim.GEAR.tolist())) == 256


def test_chunks_follow_content():
    """A passage moved by some bytes has nearly all its chunks again; sizes stay within bounds."""
    rng = random.Random(2)
    passage = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(20000)).encode()
    cache = fim.Chunks()
    borders = [d.borders for d in fim.documents([passage, b"moved " + passage, passage[1000:]], cache)]
    sizes = [b - a for own in borders for a, b in zip(own, own[1:-1])]
    assert fim.LEAST_CHUNK <= min(sizes) and max(sizes) <= fim.MOST_CHUNK
    assert cache.found > 0.64 * cache.asked  # two of three are copies
    alone = [next(fim.documents([t], fim.Chunks())).borders for t in (passage, b"moved " + passage, passage[1000:])]
    assert alone == borders  # whatever stands before a text in its slice


def test_cache_starts_anew():
    cache = fim.Chunks(kept_bytes=300)
    for i in range(100):
        assert cache.of(b"%d word" % i) == (2, len(b"%d word" % i), True, True)
    assert sum(map(len, cache.kept)) <= 300


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "a b c")] * 4, "doc_id long, text string")
    assert len(fim.transform(df).collect()) == 4
    assert fim.transform(df.limit(0)).count() == 0


def test_query(spark, con, small):
    good, note = compare(QUERIES["op13_fim"](spark, small), con, ORACLES["op13_fim"])
    assert good, note
