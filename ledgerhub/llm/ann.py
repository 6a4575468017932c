"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by pseudo-rotations, random signs followed by a fast Hadamard transform
three times, and put into the bucket of the nearest signed axis. There are several tables with
rotations of their own. A query looks into the buckets of its nearest axes in each table; the
vectors found are compared on their original values.

Equal vectors are told by a 128-bit hash: a query group needs no more of them than the k + 1 with
the smallest ids, since one may be the query itself. Large buckets are dealt over several groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerhub.llm.common import written_once

TABLES = 12
PROBES = 10
ROTATIONS = 3
SEED = 20
GROUP_ROWS = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix; their length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(vectors: np.ndarray, table: int) -> np.ndarray:
    """Unit vectors in the directions of the rows, padded to a power of two and rotated."""
    n = 1 << max(0, vectors.shape[1] - 1).bit_length()
    x = np.zeros((len(vectors), n))
    # dividing by the largest component first keeps squares finite
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    x[:, :vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    signs = np.random.default_rng([SEED, table]).integers(0, 2, (ROTATIONS, n)) * 2.0 - 1
    for s in signs:
        x = hadamard(x * s)
    return x


def nearest_axes(vectors: np.ndarray, table: int, count: int) -> np.ndarray:
    """Codes of the signed axes nearest to each row, nearest first; ties to the smaller code."""
    x = rotated(vectors, table)
    scores = np.stack([x, -x], 2).reshape(len(x), -1)
    if count == 1:
        return scores.argmax(1)[:, None]
    return np.argsort(-scores, axis=1, kind="stable")[:, :count]


def matrices(batch: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length, in double precision."""
    lengths = np.diff(batch.offsets.to_numpy())
    values = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        yield places, values[starts[places][:, None] + np.arange(n)]


def buckets(vector: Column, tables: int, probes: int) -> Column:
    """array<int> of table * 2^24 + axis code: ``probes`` nearest axes in each table."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list = [None] * len(batch)
            for places, x in matrices(batch):
                codes = np.concatenate(
                    [nearest_axes(x, t, probes) + (t << 24) for t in range(tables)], axis=1)
                for place, row in zip(places, codes.astype(np.int32)):
                    out[place] = row
            yield pa.array(out, pa.list_(pa.int32()))

    return run(vector)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, n, h1, h2) of the rows whose vector takes part, hashed by value."""
    plain = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.col("v")
    rows = df.select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double") + 0.0).alias("v"))
    rows = rows.where(
        F.col("id").isNotNull() & v.isNotNull() & F.forall(v, plain) & F.exists(v, lambda x: x != 0))
    return rows.select("id", "v", F.size("v").alias("n"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(SEED), "v").alias("h2"))


PARTIAL = "q1 long, q2 long, id long, score double"


def best_of(own: pa.Table, asking: pa.Table, k: int) -> dict[str, list]:
    """The k nearest rows of a group for each query that looks into it."""
    ids = own["id"].to_numpy()
    x = np.stack(own["v"].to_numpy()) if len(ids) else None
    out: dict[str, list] = {"q1": [], "q2": [], "id": [], "score": []}
    if x is None:
        return out
    for q1, q2, v in zip(asking["q1"].to_pylist(), asking["q2"].to_pylist(), asking["v"].to_numpy()):
        with np.errstate(over="ignore"):
            score = np.sqrt(((x - v) ** 2).sum(1))
        near = np.lexsort((ids, score))[:k]
        out["q1"] += [q1] * len(near)
        out["q2"] += [q2] * len(near)
        out["id"] += ids[near].tolist()
        out["score"] += score[near].tolist()
    return out


def found_in(index: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The k nearest (q1, q2, id, score) for each query vector in the buckets it looks into."""
    counts = written_once(index.groupBy("n", "bucket").agg(
        F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("parts")), "ann-buckets")
    where = ["n", "bucket"]
    dealt = index.join(counts, where).select(
        "n", "bucket", F.pmod("id", "parts").alias("part"), "id", "v")
    asked = asking.join(counts, where).select(
        "n", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1).cast("array<long>")).alias("part"), "q1", "q2", "v")

    def search(key: tuple, own: pa.Table, queries: pa.Table) -> pa.Table:
        found = best_of(own, queries, k)
        return pa.table({"q1": pa.array(found["q1"], pa.int64()), "q2": pa.array(found["q2"], pa.int64()),
                         "id": pa.array(found["id"], pa.int64()), "score": pa.array(found["score"], pa.float64())})

    group = ["n", "bucket", "part"]
    rows = dealt.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(search, PARTIAL)
    once = rows.groupBy("q1", "q2", "id").agg(F.min("score").alias("score"))
    near = W.partitionBy("q1", "q2").orderBy("score", "id")
    return once.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k).drop("r")


def search(
    df: DataFrame, queries: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows found for each row where ``queries`` holds.

    Nearest by Euclidean distance of the original vectors, nearest first, ties to the smaller id;
    fewer than k only if there are fewer. Rows with a null key, and vectors that are null, empty,
    zero or hold null or non-finite components, take no part; vectors of different lengths don't
    meet. Rows with equal keys and vectors count once; a key's other vectors are found, but not by
    queries of that key. Queries for which the buckets they look into hold too few rows look into
    all buckets of one table.
    """
    rows = usable(df.select(F.col(key).alias("key_"), F.col(vector).alias("vector_")), "key_", "vector_").distinct()
    rows = written_once(rows, "ann-rows")
    asking = usable(df.where(queries).select(F.col(key).alias("key_"), F.col(vector).alias("vector_")), "key_", "vector_")
    asking = written_once(asking.select("id", "h1", "h2", "n", "v").distinct(), "ann-queries")
    first = W.partitionBy("h1", "h2").orderBy("id")
    kept = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r")
    index = written_once(kept.select("id", "n", "v", buckets(F.col("v"), tables, 1).alias("b")), "ann-index")
    index = index.select("id", "n", "v", F.explode("b").alias("bucket"))
    groups = asking.groupBy(F.col("h1").alias("q1"), F.col("h2").alias("q2"), "n").agg(F.first("v").alias("v"))
    groups = written_once(groups, "ann-groups")
    look = groups.select("q1", "q2", "n", "v", F.explode(buckets(F.col("v"), tables, probes)).alias("bucket"))
    found = written_once(found_in(index, look, k + 1), "ann-found")
    enough = found.groupBy("q1", "q2").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > k)
    short = written_once(groups.join(enough, ["q1", "q2"], "left_anti"), "ann-short")
    wide = index.where("shiftright(bucket, 24) = 0")
    every = written_once(wide.select("n", "bucket").distinct(), "ann-every")
    rest = found_in(wide, short.join(every, "n"), k + 1)
    found = found.join(short.select("q1", "q2"), ["q1", "q2"], "left_anti").unionByName(rest)
    lists = written_once(found.groupBy("q1", "q2").agg(
        F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near")), "ann-lists")
    own = asking.select(F.col("id").alias("query_id"), F.col("h1").alias("q1"), F.col("h2").alias("q2"))
    near = own.join(lists, ["q1", "q2"]).select("query_id", F.posexplode(F.slice(F.filter(
        "near", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("place", "x"))
    return near.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
