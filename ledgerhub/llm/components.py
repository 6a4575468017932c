"""Connected components of a graph given as links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerhub.llm.common import written_once


def _with_least(links: DataFrame) -> DataFrame:
    """Both directions of stored links (u, v) with the smallest node ``m`` next to or at u."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written_once(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u")


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v), component being the smallest node reachable.

    Alternates two steps until nothing changes: every node passes its least neighbour on to its
    larger neighbours, then to its smaller ones. Links become stars around the least node in a
    number of steps that grows with the logarithm of the longest path. Every step is stored, so a
    lost executor costs one step. Links of a node with itself or with null are left out.
    """
    links = written_once(links.select("u", "v").where("u <> v"), "links")
    before = None
    while (now := _mark(links)) != before and now[0]:
        before = now
        large = _with_least(links).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_least(written_once(large.where("u <> v").distinct(), "links"))
        kept = small.where("v < u").select("u", "v", "m")
        stars = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            kept.select("u", F.col("m").alias("v")))
        links = written_once(stars.where("v < u").distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v"), F.col("v")).distinct())
