"""Every stage against a plain version of its decision, and the pipeline's rows."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from ledgerhub.llm import langid, stages
from ledgerhub.llm.queries import DOMAIN_SQL, MIX_SEED, MIX_WEIGHTS, QUERIES
from tests.llm import test_jaccard as plain_jaccard, test_mixing as plain_mixing, test_quality as plain_quality

FOLDER = "/root/testdata/sf0.001"


def as_rows(df):
    return sorted((tuple(r[c] for c in stages.DOCUMENT) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The frame each stage reads and the one it returns, stored as the driver stores them."""
    place, docs, out = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{place}/{i}")
        after = spark.read.parquet(f"{place}/{i}")
        out.append((docs, after))
        docs = after
    return out


def test_columns(steps):
    assert all(after.columns == stages.DOCUMENT for _, after in steps[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality rules", "near duplicates", "mixing", "byte pairs"]


def test_language(spark, steps):
    before, after = steps[0]
    model = langid.fit(before.where(~langid.held_out()))
    classifier = langid.Classifier(model)
    kept = []
    for r in before.collect():
        lang, score = classifier.classify(r["text"])
        if lang != "und" and score >= langid.MIN_MARGIN:
            kept.append(tuple(r[c] for c in stages.DOCUMENT))
    assert as_rows(after) == sorted(kept, key=repr)
    clean = [r for r in before.collect() if len((r["text"] or "").split()) >= 10]
    assert sum(tuple(r[c] for c in stages.DOCUMENT) in set(kept) for r in clean) >= 0.99 * len(clean)


def test_quality(spark, steps, tmp_path):
    before, after = steps[1]
    before.write.parquet(f"{tmp_path}/documents.parquet")
    verdicts = {r["doc_id"]: r["kept"] for r in QUERIES["op5_quality"](spark, str(tmp_path)).collect()}
    assert as_rows(after) == as_rows(before.where(F.col("doc_id").isin([k for k, v in verdicts.items() if v])))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stay = {r[0] for r in as_rows(after)}
    for r in before.collect():
        counts = plain_quality.brute(r["text"])
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert not (failed and r["doc_id"] in stay)
        assert failed or labels.get(r["doc_id"]) != 1 or r["doc_id"] in stay


def test_near_duplicates(steps):
    before, after = steps[2]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    classes, _, _ = plain_jaccard.brute(rows)
    assert sorted(r[0] for r in as_rows(after)) == sorted(set(classes.values()))
    assert len(set(classes.values())) < len(rows)


def test_mix(monkeypatch, steps):
    before, after = steps[3]
    rows = before.select("doc_id", F.expr(DOMAIN_SQL).alias("d"), "lang", "source", "text").collect()
    monkeypatch.setattr(plain_mixing, "WEIGHTS", MIX_WEIGHTS)
    plain = [(r["doc_id"], r["d"], r["lang"], r["source"], len(plain_quality.WORD.findall(r["text"] or ""))) for r in rows]
    uses = plain_mixing.brute(plain, 75, 2, MIX_SEED)
    assert sorted(r[0] for r in as_rows(after)) == sorted(plain[i][0] for i, _ in uses)


def test_bpe(steps):
    before, after = steps[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = sorted((r["doc_id"], hashlib.md5(b"".join(
        i.to_bytes(4, "little") for i in library.encode(r["text"], add_special_tokens=False).ids)).hexdigest()) for r in before.collect())
    got = after.collect()
    assert sorted((r["doc_id"], hashlib.md5(bytes(r["token_ids"])).hexdigest()) for r in got) == wanted
    assert all(r["round_trip"] and r["n_tokens"] * 4 == len(r["token_ids"]) for r in got)


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.exceptAll(steps[-1][1]).count() == 0 and steps[-1][1].exceptAll(got).count() == 0


ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "of the and to " * 3, None, "s", 5),
       (4, "123 !!!", "de", None, 3), (5, "long text of many words and more " * 4000, "en", "src0", 9)]


#: Ids that each stage returns for them. No language is learned from texts without letters or held out; every text fails
#: the base rule; a source without words has no epoch, one with a single long text no prefix that fits, and small ones two epochs.
ODD_STAY = {"language": [], "quality rules": [], "near duplicates": [1, 2, 2, 4, 5, None], "mixing": [4, 4, None, None],
            "byte pairs": [1, 2, 2, 4, 5, None]}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, name, stage):
    more = "component_id long, epoch int, kept boolean, token_ids int, score string"
    df = spark.createDataFrame([(*r, 1, 1, True, 1, "x") for r in ODD],
                               f"doc_id long, text string, lang string, source string, n_chars long, {more}")
    assert sorted((r["doc_id"] for r in stage(spark, df, FOLDER).collect()), key=str) == ODD_STAY[name]
    assert stage(spark, df.limit(0), FOLDER).count() == 0
