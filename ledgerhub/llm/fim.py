"""Fill-in-the-middle documents, cut at tokens that content-defined chunks count.

A rolling hash cuts each text's bytes into chunks where the bytes say so, so that equal passages give equal
chunks wherever they stand. A chunk's summary (words, characters, whether it begins and ends inside a
word) is found once and kept under its content; adding summaries up tells in which chunk a cut falls, and
only that chunk is searched. Documents stay where they are, and texts don't come back from the workers.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.llm.common import with_new

SEED = 42
#: Of 100 documents so many are rearranged, and so many of those have the suffix first.
RATE, SUFFIX_FIRST = 50, 80
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: A chunk ends where this many low bits of the rolling hash are 0, between these sizes in bytes.
CHUNK_BITS, LEAST_CHUNK, MOST_CHUNK = 9, 128, 4096
HASH_WINDOW = 32
SLICE_BYTES = 1 << 20
#: Bytes of chunks that a task keeps summaries of; beyond that it starts anew.
KEPT_BYTES = 32 << 20

_RUN = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BLANK = b" \t\n\v\f\r"
_TAILS = bytes(range(0x80, 0xC0))  # bytes inside a character of UTF-8


def _gear() -> np.ndarray:
    """256 numbers that look random: the finisher of a 64-bit mixer over 1 to 256."""
    with np.errstate(over="ignore"):
        z = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the last 32 bytes' numbers, each shifted by its distance."""
    h = GEAR[data]
    step = 1
    while step < HASH_WINDOW:
        shifted = h[:-step] << np.uint32(step)
        h[step:] += shifted
        step *= 2
    return h


def edges(begin: int, end: int, marks: np.ndarray) -> list[int]:
    """Where the chunks of bytes begin to end lie: all borders, given places behind which the hash allows one."""
    out = [begin]
    for place in marks.tolist():
        while place - out[-1] > MOST_CHUNK:
            out.append(out[-1] + MOST_CHUNK)
        if place - out[-1] >= LEAST_CHUNK:
            out.append(place)
    while end - out[-1] > MOST_CHUNK:
        out.append(out[-1] + MOST_CHUNK)
    if out[-1] < end:
        out.append(end)
    return out


class Summary(NamedTuple):
    words: int  # runs of word bytes
    chars: int  # characters that begin here
    starts_inside: bool  # the first byte belongs to a word
    ends_inside: bool


def chars(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.translate(None, _TAILS))


def summary(chunk: bytes) -> Summary:
    return Summary(len(chunk.split()), chars(chunk), chunk[0] not in _BLANK, chunk[-1] not in _BLANK)


class Chunks:
    """Summaries by content: an equal hash alone isn't taken for an equal chunk, the bytes are compared."""

    def __init__(self, kept_bytes: int = KEPT_BYTES):
        self.kept: dict[bytes, Summary] = {}
        self.left = self.kept_bytes = kept_bytes
        self.found = self.asked = 0

    def of(self, chunk: bytes) -> Summary:
        self.asked += 1
        known = self.kept.get(chunk)
        if known is not None:
            self.found += 1
            return known
        self.left -= len(chunk)
        if self.left < 0:
            self.kept.clear()
            self.left = self.kept_bytes - len(chunk)
        known = self.kept[chunk] = summary(chunk)
        return known


class Document:
    """A text as chunks: how many words begin, and how many characters, before each."""

    def __init__(self, data: bytes, borders: list[int], cache: Chunks):
        self.data, self.borders = data, borders
        self.parts = [cache.of(data[a:b]) for a, b in zip(borders, borders[1:])]
        inside = [False, *[p.ends_inside for p in self.parts]]
        self.carried = [p.starts_inside and before for p, before in zip(self.parts, inside)]
        self.begun = [0, *accumulate(p.words - c for p, c in zip(self.parts, self.carried))]
        self.chars = [0, *accumulate(p.chars for p in self.parts)]
        self.tokens = self.begun[-1] + bool(self.parts and not inside[-1])

    def chars_before(self, tokens: int) -> int:
        """Characters of the first ``tokens`` tokens: up to the end of that many words, or of the text."""
        if tokens == 0:
            return 0
        if tokens == self.tokens:
            return self.chars[-1]
        part = bisect_left(self.begun, tokens) - 1
        place = tokens - self.begun[part] - 1 + self.carried[part]
        begin = self.borders[part]
        word = next(islice(_RUN.finditer(self.data, begin, self.borders[part + 1]), place, None))
        stop = _SPACE.search(self.data, word.end())
        end = stop.start() if stop else len(self.data)
        return self.chars[part] + chars(self.data[begin:end])


def documents(texts: list[bytes], cache: Chunks) -> Iterator[Document]:
    """The texts as chunks, hashed together. No border lies so near a text's begin that another one is in its hash."""
    joined = b"".join(texts)
    marks = np.flatnonzero(rolling(np.frombuffer(joined, np.uint8)) & np.uint32((1 << CHUNK_BITS) - 1) == 0) + 1
    at = 0
    for text in texts:
        end = at + len(text)
        low, high = np.searchsorted(marks, [at, end], "right")
        yield Document(text, [b - at for b in edges(at, end, marks[low:high])], cache)
        at = end


CUT = "struct<n:long,form:string,prefix_chars:long,middle_chars:long>"


def _cuts():
    kind = pa.struct([
        ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ])
    marks = [m.encode() for m in MARKS]

    def one(doc: Document, h1: int, h2: int, wanted: str) -> dict:
        n = doc.tokens
        if wanted == "plain" or not doc.data or any(m in doc.data for m in marks):
            return {"n": n, "form": "plain"}
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        prefix = doc.chars_before(a)
        return {"n": n, "form": wanted, "prefix_chars": prefix, "middle_chars": doc.chars_before(b) - prefix}

    def sliced(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > SLICE_BYTES:
                yield group
                group, size = [], 0
            group.append(text)
            size += len(text)
        if group:
            yield group

    @F.arrow_udf(CUT)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        cache = Chunks()
        for texts, h1, h2, wanted in batches:
            own = zip(h1.to_pylist(), h2.to_pylist(), wanted.to_pylist())
            data = (t.as_py() or b"" for t in texts.cast(pa.large_binary()))
            yield pa.array([one(d, *next(own)) for group in sliced(data) for d in documents(group, cache)], kind)

    return run.asNondeterministic()


def transform(
    df: DataFrame, text: str = "text", key: str = "doc_id", seed: int = SEED, rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``df`` with n (tokens), form, prefix_chars, middle_chars and output.

    A token is a word with the white space before it; white space behind the last word is one more. What
    is cut, and how, is decided by sha256 of seed and key, so equal keys are cut by the same numbers; a
    null key reads as ''. A text is plain, its output the text itself, if it is null (then ''), empty or
    contains a mark, or if its key says so. A prefix, middle or suffix may be empty. Texts of any length
    are cut whole; repeated rows all stay. Columns of these names are replaced.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    wanted = F.when(h[2] % 100 >= rate, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    whole = F.coalesce(F.col(text), F.lit(""))
    found = with_new(df, cut_=_cuts()(whole, h[0], h[1], wanted))
    made = ["n", "form", "prefix_chars", "middle_chars"]
    out = with_new(found, **{c: F.col(f"cut_.{c}") for c in made}).drop("cut_")
    size = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = whole.substr(F.lit(1), size[0]), whole.substr(size[0] + 1, size[1])
    suffix = whole.substr(size[0] + size[1] + 1, F.lit(2**31 - 1))
    return with_new(out, output=F.when(F.col("form") == "plain", whole).when(
        F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle),
    ).otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form alone; marks occur nowhere but between the parts."""
    after = lambda x, mark: F.substr(x, F.lit(1) + F.length(mark))
    second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    body = F.substr(output, F.lit(1 + len(PREFIX)))
    one = F.when(form == "psm", F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    rest = after(body, F.concat(one, second))
    two = F.substring_index(rest, MIDDLE, 1)
    middle = after(rest, F.concat(two, F.lit(MIDDLE)))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(
        F.concat(two, middle, one))
