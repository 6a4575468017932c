"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerhub.scratch import run_folder, shared_folder, written_once

__all__ = [
    "WORD", "fold_of", "long_rows", "numbers", "planes", "read", "run_folder", "shard_of", "shared_folder",
    "slices", "tokenized", "with_new", "word_hashes", "written_once",
]

#: A word: a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def long_rows(spark: SparkSession, rows: int = 1000) -> None:
    """Send texts to Python workers in batches of 1,000 rows, unless the session asks for others.

    Spark's default of 10,000 makes batches of tens of MB, held by the JVM and the worker alike.
    """
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, str(rows))


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    long_rows(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(key: str, folds: int) -> Column:
    """crc32 of the key's text form, modulo ``folds``; a null key has the text ''."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def with_new(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with new columns last; a column of the same name is replaced."""
    return df.drop(*columns).select("*", *[c.alias(n) for n, c in columns.items()])


def slices(texts: pa.Array, max_chars: int) -> Iterator[list[str]]:
    """The texts (null: empty) in order, in lists of about ``max_chars`` characters; one text is never cut."""
    group: list[str] = []
    size = 0
    for text in texts:
        value = text.as_py() or ""
        if group and size + len(value) > max_chars:
            yield group
            group, size = [], 0
        group.append(value)
        size += len(value)
    if group:
        yield group


def tokenized(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of the texts, A-Z in lower case, one after the other, and how many each text has."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten()
    some = pc.not_equal(words, "")
    offsets = split.offsets.to_numpy()
    found = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return words.filter(some), np.diff(found[offsets - offsets[0]])


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word, the same in every task; distinct words are hashed once."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    return hashes[coded.indices.to_numpy()]


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte of equal place, compressed: small numbers take few bytes."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def numbers(data: bytes, kind: type, count: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(data, max_output_size=count * width), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, count).T).view(kind).ravel()


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so the keys of a shard lie together in sorted keys."""
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
