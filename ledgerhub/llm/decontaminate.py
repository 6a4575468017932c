"""Benchmark passages in documents, found by a generalised suffix automaton of the benchmark's items.

Items are dealt into blocks of a bounded number of words; a task builds one block's automaton.
Documents stay where they are: every task walks the words of its texts through the automata and keeps,
at each word, the state and the length of the longest match that ends there. A match as long as a
window (or as a whole shorter item) marks its words, and its state names the items. No text is shuffled.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerhub.llm.common import with_new, written_once

#: A word of a normalised text (A-Z in lower case): a run of digits, a-z and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Words of the items of one automaton; bounds what one task builds and one worker holds.
BLOCK_WORDS = 200_000
#: Pickled automata that documents are walked through in one pass; more are walked in further passes.
PASS_BYTES = 64 << 20

_KEPT = frozenset(range(0x30, 0x3A)) | frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
#: Byte by byte: A-Z to a-z, bytes of words as they are, all others to a space. Lengths stay.
_NORMAL = bytes(_LOWER.get(c, c if c in _KEPT else 0x20) for c in range(256))

Span = tuple[int, int]
FOUND = "struct<n_words:long,spans:array<struct<start:int,end:int>>,items:array<string>>"


def normal(text: bytes) -> bytes:
    """The text with one byte for each of its own, of which ``split`` gives the words."""
    return text.translate(_NORMAL)


@dataclass
class Automaton:
    """All substrings (in words) of a block's items.

    ``first``/``to`` hold one arc of each state, ``more`` the others by state << 32 | word; the root's arcs
    are ``root``. ``holders`` tells for the state of a window the items with that window, ``short`` for
    the state of a whole shorter item its length and ids. ``anchor`` and ``near`` lead from any state
    to the next such state on its suffix links (0: none).
    """

    window: int
    words: dict[bytes, int] = field(default_factory=dict)
    root: array = field(default_factory=lambda: array("i"))
    first: array = field(default_factory=lambda: array("i"))
    to: array = field(default_factory=lambda: array("i"))
    more: dict[int, int] = field(default_factory=dict)
    link: array = field(default_factory=lambda: array("i"))
    length: array = field(default_factory=lambda: array("i"))
    anchor: array = field(default_factory=lambda: array("i"))
    near: array = field(default_factory=lambda: array("i"))
    holders: dict[int, list[str]] = field(default_factory=dict)
    short: dict[int, list[tuple[int, list[str]]]] = field(default_factory=dict)
    least: int = 0

    def walk(self, words: list[bytes]) -> tuple[list[Span], set[str]]:
        """Spans of hit words, in order and apart, and the items whose windows occur."""
        root, first, to, more, link, length = self.root, self.first, self.to, self.more, self.link, self.length
        near, window, least, code = self.near, self.window, self.least, self.words.get
        spans: list[Span] = []
        states: set[int] = set()
        whole: set[tuple[int, int]] = set()
        state = matched = 0
        for place, word in enumerate(words):
            w = code(word, -1)
            if w < 0:
                state = matched = 0
                continue
            while state:
                if first[state] == w:
                    state = to[state]
                    break
                target = more.get(state << 32 | w)
                if target:
                    state = target
                    break
                state = link[state]
                matched = length[state]
            else:
                state = root[w]
            matched += 1
            if matched < least:
                continue
            size = 0
            if matched >= window:
                size = window
                states.add(self.anchor[state])
            at = near[state]
            while at:
                for n, (words_of, _) in enumerate(self.short[at]):
                    if matched >= words_of:
                        size = max(size, words_of)
                        whole.add((at, n))
                at = near[link[at]]
            if size:
                join_span(spans, place + 1 - size, place + 1)
        items = {i for s in states for i in self.holders[s]}
        return spans, items.union(*(self.short[s][n][1] for s, n in whole))


def join_span(spans: list[Span], start: int, end: int) -> None:
    """Add a span that ends at or behind all others, joined with those that it meets."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append((start, end))


def build(items: list[tuple[list[bytes], list[str]]], window: int) -> Automaton:
    """The automaton of items, each given by its words and the ids of the rows that have them."""
    a = Automaton(window)
    arcs: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def state_of(size: int, own: dict[int, int], to: int) -> int:
        arcs.append(own)
        length.append(size)
        link.append(to)
        return len(arcs) - 1

    def split(p: int, w: int, q: int) -> int:
        """A state for those strings of q that go on from p by w, which occur at more places."""
        if length[p] + 1 == length[q]:
            return q
        copy = state_of(length[p] + 1, dict(arcs[q]), link[q])
        link[q] = copy
        while p != -1 and arcs[p].get(w) == q:
            arcs[p][w] = copy
            p = link[p]
        return copy

    def extend(last: int, w: int) -> int:
        if w in arcs[last]:
            return split(last, w, arcs[last][w])
        new = state_of(length[last] + 1, {}, 0)
        p = last
        while p != -1 and w not in arcs[p]:
            arcs[p][w] = new
            p = link[p]
        if p != -1:
            link[new] = split(p, w, arcs[p][w])
        return new

    coded = [([a.words.setdefault(w, len(a.words)) for w in words], ids) for words, ids in items if words]
    for codes, _ in coded:
        last = 0
        for w in codes:
            last = extend(last, w)
    for codes, ids in coded:
        state, size = 0, 0
        for w in codes:
            state, size = arcs[state][w], size + 1
            if size > window:
                size = window
                while length[link[state]] >= window:
                    state = link[state]
            if size == window:
                a.holders.setdefault(state, []).extend(ids)
        if len(codes) < window:
            a.short.setdefault(state, []).append((len(codes), ids))
    a.holders = {s: sorted(set(ids)) for s, ids in a.holders.items()}
    a.least = min((min(len(codes), window) for codes, _ in coded), default=window)
    a.root = array("i", (arcs[0][w] for w in range(len(a.words))))
    a.link, a.length = array("i", link), array("i", length)
    a.first, a.to = array("i", [-1]) * len(arcs), array("i", [0]) * len(arcs)
    a.anchor, a.near = array("i", [0]) * len(arcs), array("i", [0]) * len(arcs)
    for state in np.argsort(np.array(length), kind="stable")[1:].tolist():
        if length[state] >= window:
            a.anchor[state] = state if length[link[state]] < window else a.anchor[link[state]]
        a.near[state] = state if state in a.short else a.near[link[state]]
        for n, (w, target) in enumerate(arcs[state].items()):
            if n:
                a.more[state << 32 | w] = target
            else:
                a.first[state], a.to[state] = w, target
    return a


def automata(
    items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(block, automaton, size): pickled automata of all items with a word, stored."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"),
        F.array_join(F.regexp_extract_all(lowered, F.lit(TERM), 0), " ").alias("words"),
    ).where("words <> ''")
    rows = written_once(rows.groupBy("words").agg(F.collect_set("id").alias("ids")), "items")
    total = rows.agg(F.sum(F.size(F.split("words", " ")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))

    def one(key: tuple, table: pa.Table) -> pa.Table:
        texts = (t.as_py().encode().split(b" ") for t in table["words"])
        data = pickle.dumps(vars(build(list(zip(texts, table["ids"].to_pylist())), window)))
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int32()), "automaton": pa.array([data], pa.binary()),
            "size": pa.array([len(data)], pa.int64()),
        })

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)).cast("int"))
    return written_once(dealt.groupBy("block").applyInArrow(one, "block int, automaton binary, size long"), "automata")


def passes(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Blocks of (block, size), put together while they stay within ``most``."""
    out: list[list[int]] = []
    filled = most
    for block, size in sizes:
        if filled + size > most and (not out or out[-1]):
            out.append([])
            filled = 0
        out[-1].append(block)
        filled += size
    return out


def _walked(spark: SparkSession, pickled: list[bytes]):
    shared = spark.sparkContext.broadcast(pickled)

    @F.arrow_udf(FOUND)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        loaded = [Automaton(**pickle.loads(x)) for x in shared.value]
        kind = pa.struct([
            ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ])
        for texts, earlier in batches:
            out = []
            for text, before in zip(texts.cast(pa.large_binary()), earlier):
                words = normal(text.as_py() or b"").split()
                known = before.as_py() or {"spans": [], "items": []}
                spans = [(s["start"], s["end"]) for s in known["spans"]]
                items = set(known["items"])
                for a in loaded:
                    more, ids = a.walk(words)
                    items |= ids
                    if spans and more:
                        found, spans = sorted(spans + more), []
                        for start, end in found:
                            join_span(spans, start, max(end, spans[-1][1] if spans else 0))
                    spans = spans or more
                out.append({
                    "n_words": len(words), "spans": [{"start": s, "end": e} for s, e in spans], "items": sorted(items),
                })
            yield pa.array(out, kind)

    return run.asNondeterministic()


def mark(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS, pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_spans (start and end in words, apart and in order) and hit_items (sorted ids).

    A window is ``window`` consecutive words of an item; an item of fewer words is one window. A
    document's word is hit if it lies inside an occurrence of a window. Null and empty texts have no
    words, and an item without words has no window. A null item id reads as ''. Items are told apart by
    id: rows with the same id are one item, rows of the same text under several ids several. The ids of
    one text, and a document, must fit a row. Texts are walked whole, whatever their length. Repeated
    documents all stay; without items nothing is hit. Columns of these names are replaced.
    """
    spark = docs.sparkSession
    stored = automata(items, item_id, item_text, window, block_words)
    sizes = [(r["block"], r["size"]) for r in stored.select("block", "size").orderBy("block").collect()]
    found = with_new(docs, found_=F.lit(None).cast(FOUND))
    for number, blocks in enumerate(passes(sizes, pass_bytes) or [[]]):
        if number:
            found = written_once(found, "marked")
        pickled = [r["automaton"] for r in stored.where(F.col("block").isin(blocks)).orderBy("block").collect()]
        found = with_new(found.withColumn("before_", F.col("found_")),
                         found_=_walked(spark, pickled)(F.col(text), F.col("before_"))).drop("before_")
    hit = F.aggregate("found_.spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return with_new(
        found, n_words=F.col("found_.n_words"), n_hit=hit, hit_spans=F.col("found_.spans"),
        hit_items=F.col("found_.items"),
    ).drop("found_")


def _without(limit: int):
    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array([cut(t.as_py(), s.as_py(), limit) for t, s in zip(texts, spans)], pa.string())

    return run


def cut(text: str | None, spans: list[dict] | None, limit: int) -> str | None:
    """The text without the spans of ``limit`` words or more, each from its first to its last character."""
    long = [s for s in spans or [] if s["end"] - s["start"] >= limit]
    if not long:
        return text
    data = text.encode()
    inside = np.frombuffer(normal(data), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    kept, at = [], 0
    for s in long:
        kept.append(data[at:begins[s["start"]]])
        at = ends[s["end"] - 1]
    return b"".join([*kept, data[at:]]).decode()


def decontaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", max_span: int = WINDOW, max_coverage: float = 0.5,
    **how,
) -> DataFrame:
    """``mark`` with clean_text and dropped: the text without spans of ``max_span`` words and more.

    A document of whose words more than ``max_coverage`` are hit is dropped: clean_text is null. Other
    texts, null and empty ones too, come back as they are but for those spans.
    """
    marked = mark(docs, items, text, **how)
    over = F.col("n_hit") > max_coverage * F.col("n_words")
    cleaned = F.when(F.size("hit_spans") > 0, _without(max_span)(F.col(text), F.col("hit_spans"))).otherwise(F.col(text))
    return with_new(with_new(marked, dropped=over), clean_text=F.when(~over, cleaned))
