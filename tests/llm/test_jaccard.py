"""Classes against brute force over all pairs; the index loses no link."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerhub.llm import jaccard
from ledgerhub.llm.components import components
from ledgerhub.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    """(least key reachable by key, links) of (key, text) rows."""
    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    where = defaultdict(set)
    for i, (_, s) in enumerate(sets):
        for x in s:
            where[x].add(i)
    root = {k: k for k, _ in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = set()
    for i, (k, s) in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < i}:
            t = sets[j][1]
            both = len(s & t)
            if 100 * both >= 80 * (len(s) + len(t) - both):
                links.add((i, j))
                a, b = sorted((find(k), find(sets[j][0])))
                root[b] = a
    return {k: find(k) for k in root}, links, sets


def made_texts(seed, groups=40):
    """Groups of copies with a few words changed, added or dropped, near the limit of similarity."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = []
    for _ in range(groups):
        n = rng.choice([1, 3, 5, 6, 8, 9, 11, 13, 17, 25, 40, 80, 200, 500, 900])
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(rng.choice([1, 2, 5, 12])):
            own = list(base)
            for _ in range(rng.randrange(0, 2 + n // 30)):
                at = rng.randrange(len(own) + 1)
                kind = rng.random()
                if kind < 0.4 and own:
                    own[at % len(own)] = rng.choice(vocabulary)
                elif kind < 0.7:
                    own.insert(at, rng.choice(vocabulary))
                elif own:
                    del own[at % len(own)]
            text = " ".join(own)
            texts.append(text + " " + passage if rng.random() < 0.2 else text.upper() if rng.random() < 0.1 else text)
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_index_loses_no_link(seed):
    texts = made_texts(seed, 120)
    _, links, sets = brute(list(enumerate(texts)))
    value, owner = jaccard.shingled(texts)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(s) for _, s in sets]
    index = defaultdict(set)
    for sig, text in jaccard.signatures(value, owner, len(texts), jaccard.bands(max(len(s) for _, s in sets))):
        for s, t in zip(sig.tolist(), text.tolist()):
            index[s].add(t)
    found = {(i, j) for b in index.values() for i in b for j in b if i > j}
    unequal = {(i, j) for i, j in links if sets[i][1] != sets[j][1]}
    assert len(unequal) > 50 and unequal <= found


def test_bands():
    for size in range(1, 3000):
        for partner in range(size, jaccard.largest_partner(size) + 1):
            need = jaccard.most_differing(size, partner)
            if need and partner in (size, size + 1, jaccard.largest_partner(size)):
                own = [b for b in jaccard.bands(4000) if b.low <= size < b.top and partner <= b.high] if size < 60 else None
                assert own is None or all(b.segments * b.credits >= need + 1 + b.spare for b in own) and own
    for b in jaccard.bands(20000):
        assert b.spare >= 0 and b.segments * b.credits == jaccard.most_differing(b.top - 1, b.high) + 1 + b.spare


def test_bitmaps_never_refuse_a_link():
    texts = made_texts(4, 150)
    _, links, sets = brute(list(enumerate(texts)))
    value, owner = jaccard.shingled(texts)
    size = np.bincount(owner, minlength=len(texts))
    own = jaccard.Sets(size, jaccard.bitmaps(value, size))
    a, b = np.array(sorted(links)).T
    assert (own.slack(a, b) >= 0).all()
    unlike = [(i, j) for i in range(60) for j in range(60, 120) if len(sets[i][1]) > 30 and not sets[i][1] & sets[j][1]]
    a, b = np.array(unlike).T
    assert (own.slack(a, b) < 0).all()


def test_pairs_of_buckets():
    """Small buckets together and one by one as large ones give pairs that make the same classes."""
    texts = made_texts(6, 60)
    value, owner = jaccard.shingled(texts)
    size = np.bincount(owner, minlength=len(texts))
    bits, some = jaccard.bitmaps(value, size), np.flatnonzero(size)
    own = jaccard.Sets(size, bits)
    doc = np.concatenate([some[:40], some[20:70], some[90:91]])
    bucket = np.repeat([1, 2, 3], [40, 50, 1])
    for phase in (0, 1, 2):
        args = (doc, size[doc], [bits[i] for i in doc], doc, bucket)
        a, b = jaccard.pairs_of(*args, phase)
        assert (own.slack(a, b) >= 0).all() and (a < b).all()
        if phase == 2:
            wanted = {(x, y) for lot in (some[:40], some[20:70]) for x in lot for y in lot if x < y and own.slack(np.array([x]), np.array([y]))[0] >= 0}
            assert set(zip(a.tolist(), b.tolist())) == wanted


@pytest.mark.parametrize("part,small,chunk", [(3, 2, 7), (500, 4, 50), (500, 64, 5000)])
def test_classes(spark, monkeypatch, part, small, chunk):
    monkeypatch.setattr(jaccard, "PART_SETS", part)
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "CHUNK_ROWS", chunk)
    texts = made_texts(9)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, texts[0]), (None, texts[0]), (5003, "x " * 40000)]
    rows += [(rows[0][0], texts[0])] * 2 + [(6000, texts[3]), (6000, texts[-1]), (5004, "a\x0bb\x1cc d e f g")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, component_id string, least int")
    got = jaccard.classes(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    wanted, _, _ = brute(rows)
    expected = sorted((str(k), len(shingles(t)), None if k is None else wanted[k]) for k, t in rows)
    assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == expected
    assert jaccard.classes(df.limit(0)).count() == 0


def test_large_buckets_are_one_star_at_first(spark, monkeypatch):
    """Near copies far above a part give a pair each, around one hub, in phase 0; other buckets are as before."""
    monkeypatch.setattr(jaccard, "PART_SETS", 4)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base + [f"own{k}"]) for k in range(60)] + ["other " + " ".join(f"v{i}" for i in range(99)) + f" x{k}" for k in range(3)]
    value, owner = jaccard.shingled(texts)
    size = np.bincount(owner, minlength=len(texts))
    rows = [(1 if i < 60 else 2, i, int(size[i]), b, i, 60 if i < 60 else 3) for i, b in enumerate(jaccard.bitmaps(value, size))]
    df = spark.createDataFrame(rows, "bucket long, doc_id long, n_shingles long, bits binary, class long, sets long")
    pairs = {tuple(r) for r in jaccard.candidates(df, 0).collect()}
    star = [p for p in pairs if p[0] < 60]
    assert len(star) == 59 and len(set.intersection(*map(set, star))) == 1
    assert len(pairs) == 61 and {x for p in pairs if p[0] >= 60 for x in p} == {60, 61, 62}


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    links += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in links:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in list(root)} and len(got) == len(root)


def test_query(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
        wanted, _, sets = brute(rows)
        size = {k: len(s) for k, s in sets}
        got = QUERIES["op2_jaccard"](spark, folder).collect()
        assert len(got) == len(rows)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {k: (size[k], wanted[k]) for k, _ in rows}
