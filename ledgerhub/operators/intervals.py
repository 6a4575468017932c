"""Sets of whole numbers as intervals, per company: which entry numbers a table holds, which are missing.

An interval is a row (keys, lo, hi) of the numbers from ``lo`` up to but not including ``hi``. Every
operation cuts its input at the borders of number ranges and works on (keys, range) groups, so a
company with most of the numbers is many tasks. Only pieces that end at such a border go to a second,
small step that joins them again. Times are intervals of their microseconds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.sizing import broadcast_within

#: Numbers in a range. A range's numbers, or intervals, are sorted in one task.
WIDTH = 1 << 20


def _range(column: Column, width: int) -> Column:
    """Number of the range, exact for any long: the remainder is taken off before dividing."""
    return F.call_function("div", column - F.pmod(column, F.lit(width)), F.lit(width))


def _islands(pieces: DataFrame, by: Sequence[str]) -> DataFrame:
    """Intervals that touch or overlap, within the same ``by``, as one."""
    order = Window.partitionBy(*quoted(by)).orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0)
    marked = pieces.withColumn("_begins", begins)
    number = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    grouped = marked.withColumn("_island", number).groupBy(*quoted(by), "_island")
    return grouped.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island")


def _cut(intervals: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Intervals cut at the borders of ranges, with their ``_range``; empty ones and NULLs are left out."""
    first, last = _range(F.col("lo"), width), _range(F.col("hi") - 1, width)
    each = intervals.where("lo < hi").select(
        *quoted(keys), "lo", "hi", F.explode(F.sequence(first, last)).alias("_range"))
    begin = F.col("_range") * width
    return each.select(
        *quoted(keys), "_range", F.greatest("lo", begin).alias("lo"), F.least("hi", begin + width).alias("hi"))


def _joined(pieces: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Disjoint pieces of ranges as intervals: those that end at a border are joined with their neighbours."""
    begin = F.col("_range") * width
    at_border = (F.col("lo") == begin) | (F.col("hi") == begin + width)
    inner = pieces.where(~at_border).select(*quoted(keys), "lo", "hi")
    border = _islands(pieces.where(at_border).select(*quoted(keys), "lo", "hi"), keys)
    return inner.unionByName(border)


def united(intervals: DataFrame, keys: Sequence[str] = ("Entity",), width: int = WIDTH) -> DataFrame:
    """All numbers of any intervals (keys, lo, hi), which may overlap, as disjoint ones that don't touch."""
    own = [*keys, "_range"]
    return _joined(_islands(_cut(intervals, keys, width), own), keys, width)


def of_numbers(df: DataFrame, number: str, keys: Sequence[str] = ("Entity",), width: int = WIDTH) -> DataFrame:
    """The numbers of a column as intervals; repeated ones count once, NULLs not at all.

    Repeats are dropped in the map tasks, so a number that most rows have costs no more than others.
    """
    value = F.col(quoted([number])[0]).cast("long")
    distinct = df.select(*quoted(keys), value.alias("lo")).where("lo is not null").distinct()
    ranged = distinct.withColumn("_range", _range(F.col("lo"), width))
    own = [*keys, "_range"]
    place = F.row_number().over(Window.partitionBy(*quoted(own)).orderBy("lo"))
    runs = ranged.withColumn("_run", F.col("lo") - place).groupBy(*quoted(own), "_run")
    pieces = runs.agg(F.min("lo").alias("lo"), (F.max("lo") + 1).alias("hi")).drop("_run")
    return _joined(pieces, keys, width)


def _swept(sets: Sequence[DataFrame], keys: Sequence[str], width: int, wanted: Column) -> DataFrame:
    """Numbers that are in the sets ``wanted`` says, by the counts ``in0``, ``in1`` of intervals around them."""
    names = [f"in{i}" for i in range(len(sets))]
    own = [*keys, "_range"]
    pieces = reduce(DataFrame.unionByName, [
        _cut(s, keys, width).select("*", *[F.lit(int(i == k)).alias(n) for k, n in enumerate(names)])
        for i, s in enumerate(sets)])
    point = lambda at, sign: F.struct(F.col(at).alias("at"), *[(F.col(n) * sign).alias(n) for n in names])
    points = pieces.select(*quoted(own), F.explode(F.array(point("lo", 1), point("hi", -1))).alias("p")).select(
        *quoted(own), "p.*")
    points = points.groupBy(*quoted(own), "at").agg(*[F.sum(n).alias(n) for n in names])
    order = Window.partitionBy(*quoted(own)).orderBy("at")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    parts = points.select(
        *quoted(own), F.col("at").alias("lo"), F.lead("at").over(order).alias("hi"),
        *[F.sum(n).over(running).alias(n) for n in names]).where(F.col("hi").isNotNull() & wanted)
    return _joined(_islands(parts.select(*quoted(own), "lo", "hi"), own), keys, width)


def without(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("Entity",), width: int = WIDTH) -> DataFrame:
    """Numbers of ``left`` that are not in ``right``."""
    return _swept([left, right], keys, width, (F.col("in0") > 0) & (F.col("in1") == 0))


def common(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("Entity",), width: int = WIDTH) -> DataFrame:
    """Numbers that are in both."""
    return _swept([left, right], keys, width, (F.col("in0") > 0) & (F.col("in1") > 0))


def gaps(intervals: DataFrame, keys: Sequence[str] = ("Entity",), width: int = WIDTH, start: int | None = None) -> DataFrame:
    """Numbers between the least (or ``start``) and the largest of each key that are not in the set."""
    low = F.min("lo") if start is None else F.least(F.lit(start).cast("long"), F.min("lo"))
    hull = intervals.where("lo < hi").groupBy(*quoted(keys)).agg(low.alias("lo"), F.max("hi").alias("hi"))
    return without(hull, intervals, keys, width)


def size(intervals: DataFrame, keys: Sequence[str] = ("Entity",), name: str = "numbers") -> DataFrame:
    """How many numbers each key's disjoint intervals hold."""
    return intervals.groupBy(*quoted(keys)).agg(F.sum(F.col("hi") - F.col("lo")).alias(name))


def covered(
    df: DataFrame, number: str, intervals: DataFrame, keys: Sequence[str] = ("Entity",), width: int = WIDTH
) -> DataFrame:
    """Rows whose number lies in one of the disjoint intervals; each row at most once.

    Ranges without an interval are dropped first, by a broadcast of the ranges while they are measured
    few. In the others rows and intervals are sorted together and each row looks at the last interval
    that began before it, so the work doesn't grow with rows times intervals.
    """
    own = [*keys, "_range"]
    pieces = _cut(intervals, keys, width)
    value = F.col(quoted([number])[0]).cast("long")
    ranged = df.withColumn("_range", _range(value, width))
    near = ranged.join(broadcast_within(pieces.select(*quoted(own)).distinct()), own, "left_semi")
    rows = near.select(*quoted(own), value.alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("hi"),
                       F.struct(*quoted(df.columns)).alias("row"))
    marks = pieces.select(*quoted(own), F.col("lo").alias("at"), F.lit(0).alias("kind"), "hi",
                          F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
    order = Window.partitionBy(*quoted(own)).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionByName(marks).withColumn("until", F.max("hi").over(order))
    return found.where("kind = 1 and at < until").select("row.*")
