"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerhub.llm import bpe
from ledgerhub.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tables():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def wanted(library, text):
    return library.encode(text, add_special_tokens=False).ids


TEXTS = [
    "", " ", "  \n\n x", "a", "aaaaaaaaaaaa", "aaaaaaa aaaa\n\naaa", "it's they'll WE'D I'm", "été größer ñandú",
    "日本語のテキスト 12345 ½ ²", "\t\ttabs\r\nlines  nbsp x", "x<|endoftext|>y <|endoftext|>", "<|endoftext|>",
    "<|endoftext", "🙂🙃 emoji é", "\0special:x \0", "#" * 300, "word " * 500, "ab" * 3000, "�﻿",
]


def test_same_ids_and_text(tables, library):
    encoder = bpe.Encoder(tables)
    for text, ids in zip(TEXTS, encoder.encode(TEXTS), strict=True):
        assert ids.tolist() == wanted(library, text), text
        assert bpe.decode_ids(ids, tables) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_random_texts(tables, library):
    rng = random.Random(7)
    letters = "abcde  \n\t'stlr.#éüßñ1２日🙂 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(400)]
    for text, ids in zip(texts, bpe.Encoder(tables).encode(texts), strict=True):
        assert ids.tolist() == wanted(library, text), repr(text)


def test_every_assigned_character(tables, library):
    points = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "1".join(points[i:i + 500]) for i in range(0, 0x30000, 500)]
    encoder = bpe.Encoder(tables)
    bad = [i for i, t in enumerate(texts) if encoder.encode([t])[0].tolist() != wanted(library, t)]
    assert bad == []


def test_kept_words_are_bounded(tables, library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_KEPT_WORDS", 3)
    encoder = bpe.Encoder(tables)
    for text in ("one two three", "four five", "six one", "one"):
        assert encoder.encode([text])[0].tolist() == wanted(library, text)


def test_frames(spark, tables, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "same text", "y"), (3, "same text", "y"), (4, "long " * 30000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    out = bpe.decode(bpe.encode(df, tables), tables).withColumn("ids", bpe.id_array("token_ids"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == 5 and out.columns == ["doc_id", "text", "token_ids", "n_tokens", "decoded_text", "ids"]
    for key, text in ((1, ""), (2, ""), (3, "same text"), (4, "long " * 30000)):
        ids = wanted(library, text)
        assert (got[key]["ids"], got[key]["n_tokens"], got[key]["decoded_text"]) == (ids, len(ids), text)
    assert bpe.encode(df.limit(0), tables).count() == 0
    both = bpe.round_trip(df, tables)
    kept = ["doc_id", "text", "token_ids", "decoded_text", "n_tokens"]
    assert both.columns == kept and both.exceptAll(out.select(kept)).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = wanted(library, texts[r["doc_id"]])
        back = library.decode(ids, skip_special_tokens=False).encode()
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back).hexdigest()
