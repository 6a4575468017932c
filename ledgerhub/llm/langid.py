"""Language identification by compression.

Each language has a raw-content zstandard dictionary of its texts. A text is compressed in
short blocks with every dictionary; the language with the smallest sum is chosen and the text
is rejected when the next one is almost as small.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerhub.llm.common import fold_of, with_new
from ledgerhub.sizing import broadcast_within

#: Bounds of the sample the dictionaries are made of: documents of each language, bytes of a dictionary
#: and of all dictionaries together. Documents are taken whole or not at all.
SAMPLE_DOCUMENTS = 400
DICTIONARY_BYTES = 1 << 18
ALL_DICTIONARY_BYTES = 1 << 26
LEVEL = 6
BLOCK = 1024
#: A text is rejected when the second language needs less than this share more.
MIN_MARGIN = 0.01
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> bytes:
    """Lower-case words of letters, one space around each; '' when there is no letter."""
    words = _OTHER.sub(" ", text.lower()).strip()
    return f" {words} ".encode() if words else b""


@dataclass(frozen=True)
class Dictionaries:
    """Languages, those with more training documents first, and the bytes of their dictionaries."""

    languages: list[str]
    contents: list[bytes]


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Dictionaries:
    """Dictionaries from a bounded sample of labelled rows: per language those with the smallest hash of ``key``.

    Texts are taken whole, one after the other, as long as they fit into the dictionary; one that
    doesn't is passed over. Rows without text, language or key are not learned from, nor are texts
    longer than a dictionary. Languages are learned as far as whole dictionaries fit into all bytes,
    those with more rows first. First only keys and languages are read to choose; then the chosen
    texts. Of rows with the same key and language the least text is taken.
    """
    rows = train.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(text).alias("t")).where(
        f"octet_length(t) <= {DICTIONARY_BYTES} and k is not null and l is not null")
    counted = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l")
    ordered = [r["l"] for r in counted.limit(max(1, ALL_DICTIONARY_BYTES // DICTIONARY_BYTES)).collect()]
    first = W.partitionBy("l").orderBy(F.xxhash64("k"), "k")
    keys = rows.where(F.col("l").isin(ordered)).select("k", "l").distinct()
    chosen = keys.withColumn("r", F.row_number().over(first)).where(F.col("r") <= SAMPLE_DOCUMENTS)
    found = rows.join(broadcast_within(chosen), ["k", "l"]).groupBy("l", "r").agg(F.min("t").alias("t"))
    parts: dict[str, list[bytes]] = {l: [] for l in ordered}
    for r in found.orderBy("l", "r").toLocalIterator():
        letters = letters_only(r["t"])
        if sum(map(len, parts[r["l"]])) + len(letters) <= DICTIONARY_BYTES:
            parts[r["l"]].append(letters)
    return Dictionaries(ordered, [b"".join(reversed(parts[l])) for l in ordered])  # the end is the nearest


class Classifier:
    def __init__(self, model: Dictionaries):
        self.languages = model.languages
        self.compress = []
        for content in model.contents:
            if len(content) < 8:  # the library takes no shorter dictionary
                self.compress.append(zstandard.ZstdCompressor(
                    level=LEVEL, write_content_size=False, write_checksum=False).compress)
                continue
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False,
                write_dict_id=False).compress)

    def classify(self, text: str | None) -> tuple[str, float]:
        """The language, and by which share the second language's size is larger than its own."""
        data = letters_only(text or "")
        if not data or not self.languages:
            return UNKNOWN, 0.0
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(compress(b)) for b in blocks) for compress in self.compress]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)  # stable: ties to the larger language
        if len(order) == 1:
            return self.languages[0], 1.0
        best, second = sizes[order[0]], sizes[order[1]]
        return self.languages[order[0]], (second - best) / second


def classified(text: Column, model: Dictionaries) -> Column:
    """Struct column (lang_pred, score)."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        classifier = Classifier(model)
        for batch in batches:
            found = [classifier.classify(x.as_py()) for x in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang_pred", "score"])

    # else a filter on the result is pushed below the column and runs it a second time
    return run.asNondeterministic()(text)


def identify(df: DataFrame, model: Dictionaries, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    Whole texts are compressed. A null text or one without letters has language ``und`` and
    score 0; with no language learned, all have. With one language learned the score is 1. Ties
    go to the language with more training rows and are rejected, like every margin below
    MIN_MARGIN. Columns of these names are replaced.
    """
    found = with_new(df, found_=classified(F.col(text), model))
    low = (F.col("found_.lang_pred") == UNKNOWN) | (F.col("found_.score") < MIN_MARGIN)
    return with_new(
        found, lang_pred=F.col("found_.lang_pred"), score=F.col("found_.score"), rejected=low
    ).drop("found_")


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from training."""
    return fold_of(key, 4) == 2
