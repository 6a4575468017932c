"""Quality rules whose limits follow the texts of each language and source.

Counts per document are built-in array expressions inside its row. Their ratios go into
quantile sketches: histograms with a relative error below 1/512, merged by adding counts, so
that a source's sketches add up to its language's and those to that of all. Limits read from the
sketches are joined to the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerhub.llm.common import with_new, written_once

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A sketch with fewer documents gives way to that of its language, then to that of all.
MIN_GROUP = 50
#: Errors, of a quantile and of a document's own count, that a limit gives room for.
ERRORS = 2

#: What is counted, in how many parts, of what; the percent of documents below the quantile that a limit is
#: taken from, and how many times the quantile's distance from the centre it lies away. Half of a source may
#: carry symbols before they count as usual there; of the others the outer two percent are measured.
RATIOS = {
    "symbols": ("n_symbols", 100, "n_words", 60, 4),
    "dup_lines": ("n_dup_lines", 1000, "n_lines", 98, 3),
    "word_length": ("word_chars", 100, "n_words", 98, 3),
}
#: Ratios around their median, with limits on both sides. The centre of the others is 0, with an upper limit only.
CENTRED = ["word_length"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words in windows of five that are found twice or more, the first included.

    Windows are compared by 64-bit hash. Only texts with equal windows are sorted.
    """
    def hashes(ws: Column) -> Column:
        last = F.size(ws) - WINDOW
        window = lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(WINDOW)])
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window))

    def covered(hs: Column) -> Column:
        placed = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: F.coalesce(
                (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
                (F.get(s, k - 1)["h"] == x["h"]), (F.get(s, k + 1)["h"] == x["h"]), F.lit(False))),
            lambda x: x["i"]))
        return bound(bound(placed, twice), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda total, x: total + x))

    def counted(hs: Column) -> Column:
        return F.when(F.size(F.array_distinct(hs)) < F.size(hs), covered(hs)).otherwise(0)

    return F.coalesce(bound(bound(words, hashes), counted), F.lit(0)).cast("long")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of each text and ``base_failed``; a null text has no words.

    n_lines is the number of lines with a word. Columns of these names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, SPACE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    listed = df.drop(*COUNTS, "base_failed").select("*", words.alias("words_"), lines.alias("lines_"))
    counted = listed.select(
        *[c for c in listed.columns if c not in ("words_", "lines_")],
        F.size("words_").cast("long").alias("n_words"),
        F.length(F.array_join("words_", "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words_")).alias("n_repeat_words"),
        F.size("lines_").cast("long").alias("n_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return with_new(counted, base_failed=failed)


def bin_of(value: Column) -> Column:
    """The sketch's bin of a whole number: exact below 1,024, else its first ten binary digits."""
    cut = F.greatest(F.length(F.bin(value)) - 10, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(counted: DataFrame, *groups: str) -> DataFrame:
    """Mergeable sketches: documents per group, ratio and bin, of documents that pass the base rule."""
    sound = counted.where(~F.col("base_failed"))
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("ratio"), bin_of(F.expr(f"{count} * {parts} div {size}")).alias("bin"))
        for name, (count, parts, size, _, _) in RATIOS.items()
    ]))
    rows = sound.select(*groups, pairs.alias("x")).select(*groups, "x.ratio", "x.bin")
    return rows.groupBy(*groups, "ratio", "bin").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """The median and the outer quantiles, ``inner`` and ``outer``, of each group and ratio.

    The outer ones are those of the ratio's percent and of what is left to 100, each moved outwards by ERRORS
    standard errors of its rank. They are null in a group with too few documents to have such a rank, and below
    MIN_GROUP. Windows run over bins, of which there are few.
    """
    w = W.partitionBy(*groups, "ratio")
    run = sketch.select("*", F.sum("n").over(w).alias("all_"), F.sum("n").over(
        w.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)).alias("below_"))
    percent = by_ratio(lambda count, parts, size, percent, times: percent)
    room = F.col("all_") * (100 - percent) - ERRORS * F.sqrt(F.col("all_") * percent * (100 - percent))
    some = run.withColumn("room_", room)
    enough = (F.col("all_") >= MIN_GROUP) & (F.col("room_") >= 0)
    least = lambda reached: F.min(F.when(reached, F.col("bin")))
    return some.groupBy(*groups, "ratio").agg(
        least(F.col("below_") * 100 >= F.col("all_") * 50).alias("median"),
        least(enough & (F.col("below_") * 100 >= F.col("room_"))).alias("inner"),
        least(enough & ((F.col("all_") - F.col("below_")) * 100 <= F.col("room_"))).alias("outer"))


def by_ratio(value: Callable[..., int]) -> Column:
    """``value`` of the entry in RATIOS that the row's ratio has."""
    found = F.lit(None).cast("int")
    for name, entry in RATIOS.items():
        found = F.when(F.col("ratio") == name, value(*entry)).otherwise(found)
    return found


def limits(sketch: DataFrame) -> DataFrame:
    """lang, source and the limits <ratio>_low, <ratio>_high that hold for them.

    A limit lies as many times the outer quantile's distance from the centre away as RATIOS says, so it follows
    what is usual in the group. A null one limits nothing: the lower one of ratios that aren't centred, and all
    where even the sketch of all documents has too few. Sketches of a language and of all are merged from those
    of sources.
    """
    merged = [
        sketch.select(F.lit(0).alias("level"), "lang", "source", "ratio", "bin", "n"),
        sketch.groupBy("lang", "ratio", "bin").agg(F.sum("n").alias("n"))
        .select(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source"), "ratio", "bin", "n"),
        sketch.groupBy("ratio", "bin").agg(F.sum("n").alias("n"))
        .select(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"),
                F.lit(None).cast("string").alias("source"), "ratio", "bin", "n"),
    ]
    found = quantiles(merged[0].unionByName(merged[1]).unionByName(merged[2]), ["level", "lang", "source"])
    centred, times = F.col("ratio").isin(CENTRED), by_ratio(lambda count, parts, size, percent, times: times)
    centre = F.when(centred, F.col("median")).otherwise(0)
    found = found.select(
        "level", "lang", "source", "ratio", (centre + times * (F.col("outer") - centre)).alias("high"),
        F.when(centred, centre - times * (centre - F.col("inner"))).alias("low"))
    columns = [f"{name}_{side}" for name in RATIOS for side in ("low", "high")]
    wide = found.groupBy("level", "lang", "source").agg(*[
        F.max(F.when(F.col("ratio") == name, F.col(side))).alias(f"{name}_{side}")
        for name in RATIOS for side in ("low", "high")])
    level = lambda k, tag: wide.where(F.col("level") == k).select(
        F.col("lang").alias("lang_" + tag), F.col("source").alias("source_" + tag), F.struct(*columns).alias(tag))
    own, lang, every = level(0, "own"), level(1, "lng"), wide.where("level = 2").first()
    joined = own.join(lang, F.col("lang_own").eqNullSafe(F.col("lang_lng")))
    pick = lambda c: F.coalesce(
        F.col("own." + c), F.col("lng." + c), F.lit(every[c] if every else None).cast("long"))
    return joined.select(F.col("lang_own").alias("lang"), F.col("source_own").alias("source"),
                         *[pick(c).alias(c) for c in columns])


def within(name: str) -> Column:
    """Whether a document's ratio is inside its limits, or outside by less than ERRORS errors of its own count.

    The error of a count is its root, so a few symbols in a short text are no more than chance.
    """
    count, parts, size, _, _ = RATIOS[name]
    value = F.expr(f"{count} * {parts} div {size}")
    most = float((ERRORS * parts) ** 2) * F.col(count).cast("double")

    def near(limit: str) -> Column:
        off = (F.col(count) * parts - F.col(limit) * F.col(size)).cast("double")
        return off * off <= most

    low, high = f"{name}_low", f"{name}_high"
    return F.coalesce((value >= F.col(low)) | near(low), F.lit(True)) & F.coalesce(
        (value <= F.col(high)) | near(high), F.lit(True))


def judged(counted: DataFrame, held: DataFrame) -> DataFrame:
    """``counted`` with ``kept``, by the limits of each document's language and source."""
    sides = held.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"),
                        *[c for c in held.columns if c not in ("lang", "source")])
    joined = counted.join(
        sides, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    inside = ~F.col("base_failed")
    for name in RATIOS:
        inside = inside & within(name)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(inside)
    return with_new(joined, kept=kept).drop(*sides.columns)


def rules(df: DataFrame) -> DataFrame:
    """``df`` without text, with its counts, ``base_failed`` and ``kept``.

    Null languages and sources are groups of their own. A null or empty text has no words and fails the
    base rule; a very long one is counted whole, in its row. Repeated rows count each. An empty frame
    gives an empty one. The counts are stored once; sketches and verdicts are read from them.
    """
    return verdicts(with_counts(df).drop("text"))


def verdicts(counts: DataFrame) -> DataFrame:
    """``counts`` with ``kept``; they and the limits are stored, so each text is counted once."""
    counted = written_once(counts, "quality-counts")
    return judged(counted, written_once(limits(sketches(counted, "lang", "source")), "quality-limits"))


def passing(df: DataFrame) -> DataFrame:
    """Rows of ``df`` that the rules keep, texts and all. Texts are stored beside their counts, not shuffled."""
    return verdicts(with_counts(df)).where("kept").select(*df.columns)
