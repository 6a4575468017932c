"""Which rows of two tables differ, found by digests of key ranges, level by level.

A range's digest is how many rows it holds and two sums over hashes of its rows, so it does not depend on
their order, sums up from partial sums of map tasks, and tells repeated rows. Both tables are digested by
wide ranges in one aggregate; ranges that agree are done. Only rows in ranges that differ are read for the
next, finer level, and only rows of the last level's differing ranges are compared one by one. Two tables
that agree but for a few rows so cost one aggregate over each and a look at little more than those rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.scratch import written_once
from ledgerhub.sizing import broadcast_within

#: Widths of the ranges of places, one for each level: 4,096 places to the 2^20 of a first range, 2^8 to the last.
WIDTHS = (1 << 20, 1 << 8)
#: Up to so many differing ranges become a filter that reaches the scan; more are a join side.
MAX_FILTER_RANGES = 200

FACTS = ["rows", "digest", "digest2"]


@dataclass(frozen=True)
class Compared:
    """What both tables have in common: company, key, the place of a key in ranges, and the columns compared.

    ``place`` is a whole number: the key itself where it is one, so that ranges reach the scan's statistics
    and neighbours in the table lie in one range; else a hash of the key.
    """

    entity: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    place: str | None = None

    def at(self) -> Column:
        if self.place is not None:
            return F.col(quoted([self.place])[0]).cast("long")
        return F.pmod(F.xxhash64(*quoted(self.keys)), F.lit(1 << 40))

    def facts(self, sign: str) -> list[Column]:
        """Partial facts of one row; a NULL and a missing type count by their place in the hash."""
        named = [F.col(c) for c in quoted([*self.keys, *self.columns])]
        told = F.to_json(F.struct(*named), {"ignoreNullFields": "false"})
        return [
            F.lit(1).cast("long").alias(f"{sign}rows"),
            F.xxhash64(told).cast("decimal(38,0)").alias(f"{sign}digest"),
            F.xxhash64(F.lit("second"), told).cast("decimal(38,0)").alias(f"{sign}digest2"),
        ]


def _range(at: Column, width: int) -> Column:
    return F.call_function("div", at - F.pmod(at, F.lit(width)), F.lit(width))


def _both(left: DataFrame, right: DataFrame, by: list[Column], c: Compared) -> DataFrame:
    """Facts of both tables side by side per group: one union below one aggregate, sums formed in the map tasks."""
    empty = {f"{s}{f}": F.lit(0).cast("long" if f == "rows" else "decimal(38,0)").alias(f"{s}{f}") for s in "ab" for f in FACTS}
    parts = []
    for sign, df in (("a", left), ("b", right)):
        own = dict(zip([f"{sign}{f}" for f in FACTS], c.facts(sign)))
        parts.append(df.select(*by, *[(own | {k: v for k, v in empty.items() if k not in own})[n] for n in empty]))
    names = parts[0].columns[:len(by)]
    return reduce(DataFrame.unionByName, parts).groupBy(*quoted(names)).agg(*[F.sum(n).alias(n) for n in empty])


def _differs() -> Column:
    return reduce(lambda x, y: x | y, [F.col(f"a{f}") != F.col(f"b{f}") for f in FACTS])


def differing_ranges(left: DataFrame, right: DataFrame, c: Compared, width: int) -> DataFrame:
    """(entity, range) of the ranges of ``width`` places whose digests differ."""
    at = _range(c.at(), width).alias("_range")
    both = _both(left, right, [F.col(quoted([c.entity])[0]), at], c)
    return both.where(_differs()).select(*quoted([c.entity]), "_range")


def rows_within(df: DataFrame, ranges: DataFrame, c: Compared, width: int) -> DataFrame:
    """Rows of ``df`` in the ranges.

    Few ranges of a key column become a filter, which lets the scan skip files and row groups; others
    are a join side, broadcast while it is measured small.
    """
    found = ranges.limit(MAX_FILTER_RANGES + 1).collect() if c.place is not None else None
    if found is not None and len(found) <= MAX_FILTER_RANGES:
        entity, place = F.col(quoted([c.entity])[0]), F.col(quoted([c.place])[0])
        inside = [
            entity.eqNullSafe(F.lit(r[c.entity])) & (place >= r["_range"] * width) & (place < (r["_range"] + 1) * width)
            if r["_range"] is not None else entity.eqNullSafe(F.lit(r[c.entity])) & place.isNull() for r in found]
        return df.where(reduce(lambda x, y: x | y, inside, F.lit(False)))
    at = _range(c.at(), width)
    side = broadcast_within(ranges.select(F.col(quoted([c.entity])[0]).alias("_e"), F.col("_range").alias("_r")))
    same = F.col(quoted([c.entity])[0]).eqNullSafe(F.col("_e")) & at.eqNullSafe(F.col("_r"))
    return df.join(side, same, "left_semi")


def narrowed(left: DataFrame, right: DataFrame, c: Compared, widths: Sequence[int] = WIDTHS) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in the last level's ranges that differ."""
    for width in widths:
        ranges = written_once(differing_ranges(left, right, c, width), "ranges")
        left, right = rows_within(left, ranges, c, width), rows_within(right, ranges, c, width)
    return left, right


def compare(left: DataFrame, right: DataFrame, c: Compared, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """(entity, keys, left_rows, right_rows, status) of each key whose rows differ.

    ``status`` is ``missing`` (no such row right), ``extra`` (none left), ``repeated`` (another number of
    rows) or ``changed``. Rows are compared by two 64-bit sums over their JSON text, NULL told from an empty text; a
    NULL key is a key like others. Columns need the same names and types on both sides.
    """
    a, b = narrowed(left, right, c, widths)
    key = list(dict.fromkeys([c.entity, *c.keys]))
    found = _both(a, b, [F.col(k) for k in quoted(key)], c).where(_differs())
    status = F.when(F.col("brows") == 0, "missing").when(F.col("arows") == 0, "extra").when(
        F.col("arows") != F.col("brows"), "repeated").otherwise("changed")
    return found.select(
        *quoted(key), F.col("arows").alias("left_rows"), F.col("brows").alias("right_rows"), status.alias("status"))
