"""Counts against brute force, sketches, limits and the query against SQL and labels."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from check_queries import compare
from ledgerhub.llm import quality
from ledgerhub.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "one", "a b c d e", "a b c d e a b c d e", "x " * 50, "# a\n# a\n\n \n b|<>",
             "é ü x\x0by\x0cz\r\nq", "w " * 40000]
    texts += ["".join(rng.choice("ab \n") for _ in range(rng.randrange(150))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("n_words", F.lit("mine"))
    got = quality.with_counts(df).collect()
    assert len(got) == len(texts)
    for r in got:
        wanted = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == wanted
        assert r["base_failed"] == (wanted[0] < 10 or 100 * wanted[4] > 20 * wanted[0])


def test_bins(spark):
    got = spark.range(0, 5000, 7).select("id", quality.bin_of(F.col("id")).alias("b")).collect()
    assert all(r["b"] == r["id"] for r in got if r["id"] < 1024)
    assert all(0 <= r["id"] - r["b"] <= r["id"] / 512 for r in got)


def test_sketches_merge(spark):
    df = quality.with_counts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    whole = quality.sketches(df)
    parts = quality.sketches(df, "lang", "source").groupBy("ratio", "bin").agg(F.sum("n").alias("n"))
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def plain_limits(rows):
    """Limits of every (lang, source) from sorted values; rows are (lang, source, counts) of sound texts."""
    groups = defaultdict(list)
    for lang, source, c in rows:
        for key in ((lang, source), (lang,), ()):
            groups[key].append(c)

    def binned(v):
        cut = max(v.bit_length() - 10, 0)
        return v >> cut << cut

    def own(counts, ratio):
        number, parts, size, percent, times = quality.RATIOS[ratio]
        values, n = sorted(binned(c[number] * parts // c[size]) for c in counts), len(counts)
        room = n * (100 - percent) - 2 * math.sqrt(n * percent * (100 - percent))
        if n < 50 or room < 0:
            return None, None
        outer = next(v for r, v in enumerate(values, 1) if (n - r) * 100 <= room)
        if ratio not in quality.CENTRED:
            return None, times * outer
        middle = next(v for r, v in enumerate(values, 1) if r * 100 >= n * 50)
        inner = next(v for r, v in enumerate(values, 1) if r * 100 >= room)
        return middle - times * (middle - inner), middle + times * (outer - middle)

    found = {(key, ratio): own(counts, ratio) for key, counts in groups.items() for ratio in quality.RATIOS}
    none = (None, None)
    return {key: {ratio: next((found[k, ratio] for k in (key, key[:1], ()) if found[k, ratio] != none), none)
                  for ratio in quality.RATIOS} for key in groups if len(key) == 2}


def test_limits_differ_and_are_those_of_sorted_values(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    counted = quality.with_counts(docs).where("not base_failed").select("lang", "source", *quality.COUNTS, "base_failed")
    wanted = plain_limits([(r["lang"], r["source"], r.asDict()) for r in counted.collect()])
    got = quality.limits(quality.sketches(counted, "lang", "source")).collect()
    assert len(got) == len(wanted)
    for r in got:
        for ratio in quality.RATIOS:
            assert (r[f"{ratio}_low"], r[f"{ratio}_high"]) == wanted[r["lang"], r["source"]][ratio]
    for column in ("word_length_low", "word_length_high", "dup_lines_high"):
        assert len({r[column] for r in got}) > 5


def test_limits_follow_the_source(spark):
    """One symbol in ten words is usual in one source and junk in the other; a single symbol is junk nowhere."""
    plain = [f"word{i}" for i in range(200)]
    dotted = ["#" if i % 10 == 0 else w for i, w in enumerate(plain)]
    rows = [(i, " ".join(dotted), "en", "code") for i in range(60)]
    rows += [(100 + i, " ".join(plain), "en", "news") for i in range(60)]
    rows += [(200, " ".join(dotted), "en", "news"), (201, " ".join(plain[:11] + ["&"]), "en", "news"),
             (202, " ".join(w + " # & |" for w in plain), "en", "code")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(r["doc_id"] for r in quality.rules(df).where("not kept").collect()) == [200, 202]
    assert sorted(r["doc_id"] for r in df.join(quality.passing(df), "doc_id", "left_anti").collect()) == [200, 202]


def test_too_few_documents_set_no_limits(spark):
    df = spark.createDataFrame([(i, "# word & " * 2 + " ".join(f"w{i}" for i in range(20)), "en", "s") for i in range(20)],
                               "doc_id long, text string, lang string, source string")
    assert quality.rules(df).where("kept").count() == 20


def test_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good, None if i % 2 else "en", None) for i in range(60)]
    rows += [(100, good.replace(" ", " # "), None, None), (101, None, None, None), (102, good, "new", "alone")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit(1))
    got = quality.rules(df).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"] for r in got if not r["kept"]} == {100, 101}
    assert quality.rules(df.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_labels(spark, folder):
    """Junk is caught, clean documents that pass the base rule stay."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op5_quality"](spark, folder).join(labels, "doc_id").where("not base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0
    assert n.get((0, False), 0) >= 0.95 * (n.get((0, False), 0) + n.get((0, True), 0))


def test_query(spark, con, small):
    result = QUERIES["op5_quality"](spark, small)
    good, note = compare(result, con, ORACLES["op5_quality"])
    assert good, note
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
