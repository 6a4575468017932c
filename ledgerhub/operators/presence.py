"""Existence probes as semi and anti joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerhub.functions.text import quoted
from ledgerhub.sizing import distinct_within, fits_broadcast

BITS_PER_KEY = 16
# 128 MiB of bits: beyond some 60 million keys the sieve lets more rows through.
MAX_WORDS = 2**24
_SEGMENT_WORDS = 1024


def _keys_of(other: DataFrame, keys: Sequence[str], measured: bool) -> DataFrame:
    wanted = other.select(*quoted(keys)).dropna()
    return distinct_within(wanted) if measured else wanted.distinct()


def absent(
    df: DataFrame, other: DataFrame, keys: Sequence[str], measured: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; a NULL key occurs nowhere.

    ``measured`` sizes ``other`` first and broadcasts its keys when they are few, which
    spares a much larger ``df`` its shuffle. Without it Spark decides by statistics.
    """
    found = _keys_of(other, keys, measured)
    return df.join(found, list(keys), "left_anti").select(*quoted(df.columns))


def absent_from_large(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``absent`` for a small ``df`` and a very large ``other``.

    ``other`` is first cut down to the keys of ``df``, which are broadcast when measured
    small, so that ``other`` is scanned but not shuffled.
    """
    return absent(df, present(other.select(*quoted(keys)), df, keys, measured=True), keys)


def present(
    df: DataFrame, other: DataFrame, keys: Sequence[str], measured: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    found = _keys_of(other, keys, measured)
    return df.join(found, list(keys), "left_semi").select(*quoted(df.columns))


def sieved(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key may occur in ``other``: all that do, and about 1 in 100 of the rest.

    For keys too many to broadcast, before ``df`` is shuffled. A key sets three bits of one word by its
    hash; the words are broadcast, two bytes a key. NULLs count as equal. ``left_anti`` gives the others.
    """
    spark = df.sparkSession
    hashed = F.xxhash64(*quoted(keys))
    most = max(1, min(MAX_WORDS, other.count() * BITS_PER_KEY // 64))

    def bits(key: str) -> str:
        return " | ".join(f"shiftleft(1L, CAST(shiftright({key}, {n}) & 63 AS INT))" for n in (0, 6, 12))

    def word(key: str) -> str:
        return f"pmod(shiftright({key}, 18), {most}L)"

    marked = other.select(hashed.alias("_key")).selectExpr(f"{word('_key')} AS word", f"{bits('_key')} AS bits")
    words = marked.unionByName(spark.range(most).selectExpr("id AS word", "0L AS bits"))
    by_word = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = F.sort_array(F.collect_list(F.struct(F.expr(f"CAST(word % {_SEGMENT_WORDS} AS INT) AS place"), "bits")))
    segments = by_word.groupBy(F.expr(f"word DIV {_SEGMENT_WORDS}").alias("_segment")).agg(
        F.transform(listed, lambda w: w["bits"]).alias("_words"))
    held = F.expr(f"get(_words, CAST({word('_key')} % {_SEGMENT_WORDS} AS INT)) & ({bits('_key')})")
    near = (F.col("_segment") == F.expr(f"{word('_key')} DIV {_SEGMENT_WORDS}")) & (held == F.expr(bits("_key")))
    return df.withColumn("_key", hashed).join(F.broadcast(segments), near, how).drop("_key")


def sievable(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> bool:
    """Whether keys that are equal have equal hashes: the same plain types on both sides, without fractions like -0.0."""
    plain = (T.StringType(), T.IntegerType(), T.LongType(), T.ShortType(), T.ByteType(), T.DateType(), T.BooleanType())
    kinds = [df.schema[k].dataType for k in keys]
    return kinds == [other.schema[k].dataType for k in keys] and all(k in plain for k in kinds)


def parted(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """:func:`absent` for few keys next to a large ``df``, in two parts: rows that stay where they are, and those shuffled.

    The second part are the few rows that only the sieve takes for some of ``other``; None if the keys are broadcast.
    Keys that can't be sieved leave all to the second part.
    """
    wanted = other.select(*quoted(keys)).dropna()
    if fits_broadcast(wanted):
        return df.join(F.broadcast(wanted.distinct()), list(keys), "left_anti").select(*quoted(df.columns)), None
    if not sievable(df, wanted, keys):
        return None, absent(df, wanted, keys)
    return sieved(df, wanted, keys, "left_anti"), absent(sieved(df, wanted, keys), wanted, keys)


def flagged(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` with the flag ``name``: whether the row's key occurs in ``other``. One probe."""
    found = _keys_of(other, keys, False).withColumn("_found", F.lit(True))
    joined = df.join(found, list(keys), "left")
    return joined.select(*quoted(df.columns), F.col("_found").isNotNull().alias(name))


def whole_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in quoted(keys)])


def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is whole, and the others."""
    whole = whole_key(keys)
    return df.where(whole), df.where(~whole)
