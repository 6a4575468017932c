"""How far the sources of a language differ in their words, compared in cells of a cube.

Tasks count words of their documents and send one row per (language, source, word). The sources of a
language are dealt into group blocks and its kept words into term blocks. A cell (group block, group block,
term block) gets the slices of its groups over its words, each slice copied to the cells it takes part
in, and adds up the differences of every pair of its groups; the cells' sums are reduced along the terms.
All numbers are integers, so the sums are exact whatever their order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerhub.llm.common import written_once
from ledgerhub.sizing import broadcast_within

SCALE = 1_000_000_000
#: Added to every count of a kept word.
PRIOR = 5
LEAST_DOCUMENTS = 30
TOP_TERMS = 50
GROUPS_IN_BLOCK = 32
TERMS_IN_BLOCK = 4096
#: Distinct (language, source, word) that a task counts before it sends them on.
MOST_COUNTED = 200_000
ROWS_OUT = 20_000

_LETTERS = frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
#: Byte by byte: A-Z to a-z, letters and bytes beyond ASCII as they are, all others to a space.
_NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _LETTERS else 0x20 for c in range(256))

COUNTED = "lang string, source string, term string, n long, docs long"


def _rows(kept: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    """Counted words, and one row without word for each (language, source) met."""
    for (lang, source), (n, docs) in kept.items():
        terms = [None, *n]
        for at in range(0, len(terms), ROWS_OUT):
            part = terms[at:at + ROWS_OUT]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                pa.array(part, pa.binary()).cast(pa.string()),
                pa.array([n.get(t, 0) for t in part], pa.int64()), pa.array([docs.get(t, 0) for t in part], pa.int64()),
            ], ["lang", "source", "term", "n", "docs"])


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each word per (language, source), as far as this task has seen."""
    kept: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        groups = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
        for group, text in zip(groups, batch["text"].cast(pa.large_binary())):
            n, docs = kept.setdefault(group, (Counter(), Counter()))
            terms = text.as_py().translate(_NORMAL).split()
            size -= len(n)
            n.update(terms)
            docs.update(set(terms))
            size += len(n)
            if size > MOST_COUNTED:
                yield from _rows(kept)
                kept, size = {}, 0
    yield from _rows(kept)


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all documents; each group has a row with a null term as well."""
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    parts = texts.mapInArrow(count_terms, COUNTED)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers of any size."""
    whole = lambda x: x.cast("decimal(20,0)")
    over = F.greatest(whole(total + PRIOR * terms), whole(F.lit(1)))
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * whole(count + PRIOR), over)


def _block(column: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(column), blocks).cast("int")


class Audit:
    """Stored tables of a comparison: ``terms`` kept by each language, ``groups``, and ``entries`` of both."""

    def __init__(self, docs: DataFrame, least_documents: int, groups_in_block: int, terms_in_block: int):
        counts = written_once(counted(docs), "term-counts")
        words = counts.where("term IS NOT NULL")
        kept = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        kept = written_once(kept.where(F.col("docs") >= least_documents).select("lang", "term", "lang_n"), "kept-terms")
        groups = counts.where("term IS NULL").select("lang", "source")
        langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_groups")).join(
            kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        blocks = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
        langs = written_once(langs.select(
            "lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
            blocks(F.col("n_groups"), groups_in_block).alias("group_blocks"),
            blocks(F.coalesce("v", F.lit(0)), terms_in_block).alias("term_blocks"),
        ), "langs")
        within = Window.partitionBy("lang", "term_block")
        self.terms = written_once(kept.join(broadcast_within(langs), "lang").select(
            "lang", "term", "lang_n", _block("term", F.col("term_blocks")).alias("term_block"),
            share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
        ).withColumn("place", F.row_number().over(within.orderBy("term")) - 1), "terms")
        entries = written_once(words.select("lang", "source", "term", "n").join(
            self.terms.select("lang", "term", "term_block", "place", "q"), ["lang", "term"]), "entries")
        totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        found = groups.join(broadcast_within(langs), "lang").join(totals, ["lang", "source"], "left")
        found = found.withColumn("total", F.coalesce("total", F.lit(0)))
        self.groups = written_once(found.select(
            "lang", "source", "total", "v", "group_blocks", "term_blocks",
            _block("source", F.col("group_blocks")).alias("group_block"),
            share(F.lit(0), F.col("total"), F.col("v")).alias("p0"),
        ), "groups")
        of_group = self.groups.select("lang", "source", "group_block", "total", "v")
        self.entries = entries.join(broadcast_within(of_group), ["lang", "source"]).withColumn(
            "p", share(F.col("n"), F.col("total"), F.col("v")))

    def slices(self) -> DataFrame:
        """A row per group and term block: the shares that differ from ``p0``, and how many words the block has."""
        sizes = self.terms.groupBy("lang", "term_block").agg(F.count(F.lit(1)).cast("int").alias("width"))
        every = self.groups.select(
            "lang", "source", "group_block", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("term_block"),
            F.lit(None).cast("struct<place:int,p:bigint>").alias("x"),
        )
        some = self.entries.select(
            "lang", "source", "group_block", "term_block", F.struct("place", "p").alias("x"))
        key = ["lang", "source", "group_block", "term_block"]
        gathered = every.unionByName(some).groupBy(*key).agg(F.collect_list("x").alias("xs"))
        gathered = gathered.select(*key, F.col("xs.place").alias("places"), F.col("xs.p").alias("ps"))
        of_group = self.groups.select("lang", "source", "p0", "group_blocks")
        return gathered.join(broadcast_within(of_group), ["lang", "source"]).join(
            broadcast_within(sizes), ["lang", "term_block"], "left")

    def cells(self) -> DataFrame:
        """Each slice once for every group block that its own is compared with."""
        other = F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)).alias("other")
        copied = self.slices().select("*", other)
        return copied.select(
            "lang", F.least("group_block", "other").alias("low"), F.greatest("group_block", "other").alias("high"),
            "term_block", "group_block", "source", "p0", F.coalesce("width", F.lit(0)).alias("width"), "places", "ps",
        )

    def pairs(self) -> DataFrame:
        """(lang, a, b, value): the whole difference of each pair of sources, once a pair."""
        parts = self.cells().groupBy("lang", "low", "high", "term_block").applyInArrow(
            cell, "lang string, a string, b string, value long")
        return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def cell(key: tuple, table: pa.Table) -> pa.Table:
    """Sums of |p - q| over one term block for every pair of groups of two group blocks."""
    lang, low, high = (k.as_py() for k in key[:3])
    p0, width = table["p0"].to_numpy(), table["width"][0].as_py()
    shares = np.repeat(p0[:, None], width, axis=1)
    for row, (places, ps) in enumerate(zip(table["places"], table["ps"])):
        shares[row, places.values.to_numpy()] = ps.values.to_numpy()
    sources, block = table["source"].to_pylist(), table["group_block"].to_numpy()
    order = sorted(range(len(sources)), key=lambda i: (block[i], sources[i]))  # groups of the low block first
    shares, sources = shares[order], [sources[i] for i in order]
    edge = len(order) if low == high else int((block == low).sum())
    a, b, value = [], [], []
    for i in range(edge):
        begin = i + 1 if low == high else edge
        a += [sources[i]] * (len(sources) - begin)
        b += sources[begin:]
        value.append(np.abs(shares[begin:] - shares[i]).sum(axis=1))
    values = np.concatenate([*value, np.zeros(0)]).astype(np.int64)
    names = pa.array([lang] * len(a), pa.string())
    return pa.table({
        "lang": names, "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "value": pa.array(values, pa.int64()),
    })


def _ranked(found: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS,
    groups_in_block: int = GROUPS_IN_BLOCK, terms_in_block: int = TERMS_IN_BLOCK,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source that occurs in a language.

    Part ``pair`` has all other sources of the language by their difference, part ``term`` the words that
    a source uses most beyond its language. Null text, lang and source read as ''. A word is kept by a
    language if at least ``least_documents`` of its documents have it; a language that keeps none gives
    pairs of value 0. Groups without a kept word count as 0 everywhere. Repeated documents count as often
    as they occur, ties go by the name's bytes, an empty table gives no rows. Only text, lang and source
    are read. A text and the sources' names must fit a row; block sizes bound a cell, not the data.
    """
    a = Audit(docs, least_documents, groups_in_block, terms_in_block)
    pairs = written_once(a.pairs(), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        pairs.select("lang", F.col("b"), F.col("a"), "value"))
    more = a.entries.where("n > 0 AND p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(both, "pair").unionByName(_ranked(more, "term", top_terms))
