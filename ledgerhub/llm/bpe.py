"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

Distinct words of a slice of texts lie in one flat array of symbols. Each round looks all
neighbouring pairs up by binary search in the sorted pair keys, finds the lowest rank of
every word and merges that pair wherever it stands in the word. Words with no pair left
leave the array, so late rounds only touch long words.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.llm.common import slices, with_new

#: Fixed value: how byte-level tokenizers of this family cut a text into words.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SLICE_CHARS = 400_000
MAX_KEPT_WORDS = 100_000
_SHIFT = 24
_NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Tables:
    """A vocabulary as arrays, a few MB whatever the corpus."""

    pair_keys: np.ndarray  # sorted; left id << 24 | right id
    pair_ranks: np.ndarray
    pair_ids: np.ndarray  # id of the merged symbol
    byte_ids: np.ndarray  # id of each single byte
    token_bytes: np.ndarray  # bytes of all tokens, one after the other
    token_starts: np.ndarray  # one more entry than ids
    special: dict[str, int]


def load(path: str) -> Tables:
    """Tables of a byte-level BPE file of the tokenizers library; read on the driver only."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, letters = spec["model"]["vocab"], byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pieces = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
    pieces |= {i: text.encode() for text, i in special.items()}
    ordered = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    keys = np.array([vocab[a] << _SHIFT | vocab[b] for a, b in pairs], np.int64)
    ids = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    by_byte = {b: vocab[c] for c, b in letters.items()}
    return Tables(
        pair_keys=keys[order],
        pair_ranks=order.astype(np.int64),
        pair_ids=ids[order],
        byte_ids=np.array([by_byte[b] for b in range(256)], np.int64),
        token_bytes=np.frombuffer(b"".join(ordered), np.uint8),
        token_starts=np.concatenate([[0], np.cumsum([len(p) for p in ordered])]).astype(np.int64),
        special=special,
    )


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of many runs of a flat array, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _alternate(chosen: np.ndarray) -> np.ndarray:
    """Of chosen neighbouring positions, every other one from the left: merges don't overlap."""
    if len(chosen) < 2:
        return chosen
    first = np.concatenate([[True], np.diff(chosen) != 1])
    begin = np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
    return chosen[(np.arange(len(chosen)) - begin) % 2 == 0]


def merge_words(words: list[str], tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each word has."""
    raw = [w.encode() for w in words]
    symbols = tables.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    done_symbols, done_owner = [], []
    while len(symbols):
        keys = symbols[:-1] << _SHIFT | symbols[1:]
        place = np.minimum(np.searchsorted(tables.pair_keys, keys), len(tables.pair_keys) - 1)
        known = (tables.pair_keys[place] == keys) & (owner[:-1] == owner[1:])
        ranks = np.where(known, tables.pair_ranks[place], _NONE)
        begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        lowest = np.minimum.reduceat(np.append(ranks, _NONE), begins)
        sizes = np.diff(np.append(begins, len(owner)))
        of_word = np.repeat(lowest, sizes)
        ended = of_word == _NONE
        done_symbols.append(symbols[ended])
        done_owner.append(owner[ended])
        merged = _alternate(np.flatnonzero((ranks == of_word[:-1]) & (ranks != _NONE)))
        symbols = symbols.copy()
        symbols[merged] = tables.pair_ids[place[merged]]
        keep = ~ended
        keep[merged + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    if not done_symbols:
        return np.empty(0, np.int64), np.zeros(len(raw), np.int64)
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return symbols[order], np.bincount(owner, minlength=len(raw))


class Encoder:
    """Encodes slices of texts; keeps the ids of a bounded number of words between slices."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.find = regex.compile(WORD_PATTERN).findall
        marks = sorted(tables.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def words(self, text: str) -> list[str]:
        """Words of a text; strings of special tokens are words of their own."""
        if self.cut is None or not any(mark in text for mark in self.tables.special):
            return self.find(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                out.append("\0special:" + part)
            else:
                out.extend(self.find(part))
        return out

    def learn(self, fresh: list[str]) -> None:
        marks = [w for w in fresh if w.startswith("\0special:")]
        plain = [w for w in fresh if not w.startswith("\0special:")]
        ids, lengths = merge_words(plain, self.tables)
        special = [self.tables.special[w.removeprefix("\0special:")] for w in marks]
        self.number |= {w: len(self.number) + i for i, w in enumerate(plain + marks)}
        self.ids = np.concatenate([self.ids, ids, np.array(special, np.int64)])
        self.lengths = np.concatenate([self.lengths, lengths, np.ones(len(marks), np.int64)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words = [self.words(text) for text in texts]
        fresh = set().union(*words) - self.number.keys()
        if len(self.number) + len(fresh) > MAX_KEPT_WORDS:
            self.clear()
            fresh = set().union(*words)
        if fresh:
            self.learn(sorted(fresh))
        starts = np.cumsum(self.lengths) - self.lengths
        out = []
        for own in words:
            codes = np.fromiter(map(self.number.__getitem__, own), np.int64, len(own))
            out.append(self.ids[_spread(starts[codes], self.lengths[codes])].astype("<u4"))
        return out


def decode_ids(ids: np.ndarray, tables: Tables) -> str:
    """The text of ids; ids without a token have none, bytes that aren't UTF-8 become U+FFFD."""
    ids = ids[ids < len(tables.token_starts) - 1].astype(np.int64)
    begins = tables.token_starts[ids]
    where = _spread(begins, tables.token_starts[ids + 1] - begins)
    return tables.token_bytes[where].tobytes().decode("utf-8", "replace")


def encoded(text: Column, tables: Tables) -> Column:
    """Binary column: the ids as little-endian unsigned 32-bit integers, 4 bytes each."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(tables)
        for batch in batches:
            out = [i.tobytes() for group in slices(batch, SLICE_CHARS) for i in encoder.encode(group)]
            yield pa.array(out, pa.binary())

    return run(text)


def decoded(ids: Column, tables: Tables) -> Column:
    """String column: the text of ids packed by ``encoded``; null ids give ''."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            packed = (np.frombuffer(x.as_py() or b"", "<u4") for x in batch)
            yield pa.array([decode_ids(p, tables) for p in packed], pa.string())

    return run(ids)


def there_and_back(text: Column, tables: Tables) -> Column:
    """Struct column (token_ids, decoded_text): ids as ``encoded`` packs them, and the text decoded
    from them, in one pass of one Python worker."""

    @F.arrow_udf("struct<token_ids:binary,decoded_text:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(tables)
        for batch in batches:
            ids, texts = [], []
            for group in slices(batch, SLICE_CHARS):
                for own in encoder.encode(group):
                    ids.append(own.tobytes())
                    texts.append(decode_ids(own, tables))
            yield pa.StructArray.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["token_ids", "decoded_text"])

    return run.asNondeterministic()(text)


def round_trip(df: DataFrame, tables: Tables, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one: ``df`` with token_ids, n_tokens and decoded_text.

    Null and empty texts have no ids and the decoded text ''. Repeated rows are all coded; very long texts
    are coded whole, in one worker's memory.
    """
    both = with_new(df, coded_=there_and_back(F.col(text), tables))
    out = with_new(both, token_ids=F.col("coded_.token_ids"), decoded_text=F.col("coded_.decoded_text"))
    return with_new(out.drop("coded_"), n_tokens=(F.octet_length("token_ids") / 4).cast("long"))


def encode(df: DataFrame, tables: Tables, text: str = "text") -> DataFrame:
    """``df`` with ``token_ids`` (binary, 4 bytes an id) and ``n_tokens``.

    A null or empty text has no tokens. Strings of special tokens in a text become those
    tokens. Columns of these names are replaced; rows, repeated ones too, order and other columns stay.
    A very long text is encoded whole and must fit a worker's memory.
    """
    packed = with_new(df, token_ids=encoded(F.col(text), tables))
    return with_new(packed, n_tokens=(F.octet_length("token_ids") / 4).cast("long"))


def decode(df: DataFrame, tables: Tables, ids: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded_text``; special tokens are written out."""
    return with_new(df, decoded_text=decoded(F.col(ids), tables))


def id_array(ids: Column) -> Column:
    """Packed ids as array<int>."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            packed = [np.frombuffer(x.as_py() or b"", "<u4").astype(np.int32) for x in batch]
            yield pa.array(packed, pa.list_(pa.int32()))

    return run(ids)
