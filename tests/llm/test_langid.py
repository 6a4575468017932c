"""Held-out accuracy, odd rows, ties and rejection."""

import re
import zlib
from collections import Counter

import pytest
import zstandard

from ledgerhub.llm import langid
from ledgerhub.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op6_langid"](spark, FOLDER).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    tried = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in tried)
    assert right >= 0.98 * len(tried)
    long = [r for r in got if len(truth[r["doc_id"]]["text"].split()) >= 10]
    assert sum(r["lang_pred"] != truth[r["doc_id"]]["lang"] for r in long) <= 0.003 * len(long)  # some are mixed
    assert sum(r["rejected"] for r in long) <= 0.002 * len(long)
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.fixture
def train(spark):
    rows = [(i, f"the cat number{i} and the dog", "en", "x") for i in range(30)]
    rows += [(i, f"der hund und die katze haus{i}", "de", "x") for i in range(100, 120)]
    rows += [(200, None, "fr", "x"), (201, "perdu", None, "x"), (None, "nada", "es", "x"), (0, "the cat", "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_odd_rows(spark, train):
    model = langid.fit(train)
    assert model.languages == ["en", "de"]
    rows = [(1, None), (2, ""), (3, "123 ... !!"), (4, "der hund und die katze"), (4, "der hund und die katze"),
            (5, "the cat and the dog " * 30000), (6, "日本語"), (7, "THE CAT AND THE DOG!!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS lang_pred")
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert langid.identify(df, model).count() == len(rows)
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and all(got[i]["rejected"] for i in (1, 2, 3))
    assert (got[4]["lang_pred"], got[5]["lang_pred"], got[7]["lang_pred"]) == ("de", "en", "en")
    assert got[6]["score"] < langid.MIN_MARGIN and got[6]["rejected"] and got[6]["lang_pred"] in ("en", "de")


def test_nothing_learned(spark, train):
    model = langid.fit(train.limit(0))
    assert langid.Classifier(model).classify("text") == ("und", 0.0)
    one = langid.fit(train.where("lang = 'en'"))
    assert langid.Classifier(one).classify("anything") == ("en", 1.0)
    assert langid.identify(train.limit(0), one).count() == 0


def test_sample_is_bounded(train, monkeypatch):
    monkeypatch.setattr(langid, "DICTIONARY_BYTES", 100)
    found = langid.fit(train)
    assert found.languages == ["en", "de"] and all(60 < len(c) <= 100 for c in found.contents)
    assert all(c.endswith(b" ") and c.startswith(b" ") for c in found.contents)  # whole texts only
    monkeypatch.setattr(langid, "ALL_DICTIONARY_BYTES", 120)
    assert langid.fit(train).languages == ["en"]
    monkeypatch.setattr(langid, "DICTIONARY_BYTES", 20)
    assert langid.fit(train).languages == ["en"]  # of its texts only the shortest fits


OTHER = re.compile(r"[\W\d_]+")


def words(text):
    found = OTHER.sub(" ", (text or "").lower()).strip()
    return f" {found} ".encode() if found else b""


def plain_fit(rows, limit, documents):
    """Dictionaries by a loop over (key, its hash, language, text)."""
    langs = Counter(lang for key, _, lang, text in rows if key is not None and lang and text is not None)
    out = {}
    for lang in sorted(langs, key=lambda l: (-langs[l], l)):
        own = sorted({(h, key) for key, h, l, text in rows if l == lang and key is not None and text is not None})
        used = []
        for _, key in own[:documents]:
            data = words(min(text for k, _, l, text in rows if k == key and l == lang))
            if sum(map(len, used)) + len(data) <= limit:
                used.append(data)
        out[lang] = b"".join(used[::-1])
    return out


def plain_classify(text, dictionaries):
    data = words(text)
    if not data:
        return "und", 0.0
    sizes = []
    for lang, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total = 0
        for i in range(0, len(data), 1024):
            c = zstandard.ZstdCompressor(level=6, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            total += len(c.compress(data[i:i + 1024]))
        sizes.append(total)
    best = sizes.index(min(sizes))
    second = min(s for i, s in enumerate(sizes) if i != best)
    return list(dictionaries)[best], (second - sizes[best]) / second


def test_against_plain_loop(spark):
    """Every row of the smallest tables, dictionaries and sums of its own."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.selectExpr("doc_id", "xxhash64(doc_id)", "lang", "text").collect()]
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    dictionaries = plain_fit(train, 1 << 18, 400)
    got = {r["doc_id"]: r for r in QUERIES["op6_langid"](spark, "/root/testdata/sf0.001").collect()}
    for key, _, _, text in rows:
        lang, score = plain_classify(text, dictionaries)
        assert (got[key]["lang_pred"], got[key]["score"]) == (lang, pytest.approx(score, abs=1e-12))


def test_long_texts_are_learned_whole(spark):
    tail = "zyxwv utsrq " * 20
    df = spark.createDataFrame([(1, "abcde fghij " * 700 + tail, "a"), (2, "klmno " * 1500, "b")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert tail.encode() in model.contents[0]
    assert langid.Classifier(model).classify(tail)[0] == "a"
