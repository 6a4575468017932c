"""Recall against brute force, exact scores, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerhub.llm import ann
from ledgerhub.llm.queries import QUERIES


def brute(rows, queries, k):
    """{query: [(score, id)]} over (id, vector) rows."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in queries:
        own = x[np.flatnonzero(ids == q)[0]]
        score = np.sqrt(((x - own) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, score)) if ids[i] != q][:k]
        out[q] = [(score[i], int(ids[i])) for i in order]
    return out


def lists(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = ann.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(ann.hadamard(y), x)
    assert np.allclose(np.linalg.norm(ann.rotated(x[:, :11] * 1e200, 2), axis=1), 1)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    queries = [i for i, _ in rows if i % 100 == 0]
    wanted, got = brute(rows, queries, 10), lists(QUERIES["op7_ann"](spark, folder))
    assert set(got) == set(queries) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in wanted[q]}) for q in queries)
    assert hits >= 0.9 * 10 * len(queries)
    by_id = dict(rows)
    for q, near in got.items():
        assert near == sorted(near)
        for score, i in near:
            own = np.sqrt(((np.array(by_id[i], np.float64) - np.array(by_id[q], np.float64)) ** 2).sum())
            assert score == pytest.approx(own, rel=1e-12)


def test_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(300)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = [0, 5, 100, 200, 1000, 1010]
    got = lists(ann.search(df, F.col("vec_id").isin(queries), probes=8))
    assert got[0] == [(0.0, i) for i in range(1, 11)]
    assert got[5] == [(0.0, i) for i in range(11) if i != 5]
    assert got[200] == [(0.0, i) for i in range(10)]
    assert got[1000] == brute(rows, [1000], 10)[1000]


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]),
            (8, [float("inf"), 1.0]), (9, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (10, [-1.0, -0.0]), (10, [-1.0, 0.0]), (11, [3.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, id string, v int")
    got = lists(ann.search(df, F.lit(True)))
    assert set(got) == {1, 2, 10, 11}
    assert [i for _, i in got[1]] == [2, 10, 11] and got[1][0][0] == pytest.approx(2 ** 0.5)
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
